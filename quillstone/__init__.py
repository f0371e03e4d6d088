"""Quillstone: a PySpark-native engine for messy, versioned price lists."""
