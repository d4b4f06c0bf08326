"""Spark-native corpus and lexical analytics."""
