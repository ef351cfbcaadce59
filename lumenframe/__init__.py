"""Spark-native analytics over large collections of medical images."""
