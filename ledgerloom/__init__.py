"""Spark-native entity intelligence over landed, messy records."""
