"""PySpark-native splice-isoform analytics."""
