"""moneyflow: a PySpark-native analytics engine for money-in-politics data."""
