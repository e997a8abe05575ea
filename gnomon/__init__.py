"""Spark-native analytics for panorama labels: sources, functions, operators and plans."""
