"""quillgraph: a PySpark-native engine for scholarly metadata."""
