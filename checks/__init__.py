"""Registered queries, their SQL counterparts and the comparison tool."""
