"""Spark-native engine that turns recognised text and traced shapes into geography."""
