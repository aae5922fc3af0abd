"""Spark-native analytics for page annotations of digitised books and for large text corpora."""
