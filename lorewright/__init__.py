"""PySpark-native engine for building, querying and validating layered text corpora."""
