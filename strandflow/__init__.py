"""A PySpark-native engine for weighted interval data and sequencing reads."""
