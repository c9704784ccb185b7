"""Spark-native credit-risk feature engine."""
