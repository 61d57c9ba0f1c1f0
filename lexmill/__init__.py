"""lexmill: a PySpark-native engine for lexical and wiki-style corpora."""
