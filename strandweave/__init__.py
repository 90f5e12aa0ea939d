"""strandweave: a PySpark-native engine for assay evidence over sequence collections."""
