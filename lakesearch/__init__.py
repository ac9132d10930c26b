"""Lakesearch: a PySpark-native pipeline from raw stories to grounded search results."""
