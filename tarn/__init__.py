"""Spark-native lake packing, lake observability and corpus preparation."""
