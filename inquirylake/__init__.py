"""Spark-native analytics over parliamentary-inquiry records."""
