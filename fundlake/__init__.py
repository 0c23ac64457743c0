"""A PySpark-native analytics engine for listed-fund data."""
