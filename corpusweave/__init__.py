"""A PySpark-native engine for code-list registries and training-data corpora."""
