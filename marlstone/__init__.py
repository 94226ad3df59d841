"""Spark-native engine for auditing and curating conversation datasets."""
