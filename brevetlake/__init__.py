"""Spark-native analytics for patent bibliographic data."""
