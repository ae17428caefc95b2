"""Spark-native analytics over inspection events, documents and user facts."""
