"""Spark-native operators for preparing, scoring and monitoring tabular data."""
