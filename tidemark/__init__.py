"""Spark-first operators for pairing prose with time series, and for preparing training data."""
