"""Spark-native measurement of markets of paid API endpoints."""
