"""captureframe: a PySpark-native analytics engine for building-capture data."""
