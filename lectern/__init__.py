"""Spark-native analytics over time-stamped speech and conversation text."""
