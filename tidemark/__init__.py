"""Spark-native analytics over a contract of digital behaviour events."""
