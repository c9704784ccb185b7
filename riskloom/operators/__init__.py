"""Keyed operators on DataFrames."""
