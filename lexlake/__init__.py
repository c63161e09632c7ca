"""lexlake: a PySpark-native engine for lexical and bilingual text data."""
