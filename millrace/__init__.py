"""Spark-native directory integration, entity resolution and reporting."""
