"""tidemark: a PySpark-native document-intelligence engine."""
