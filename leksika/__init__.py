"""A PySpark-native engine for versioned lexical corpora."""
