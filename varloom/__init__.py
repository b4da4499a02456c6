"""Variant evidence engine and training-data operators on Spark."""
