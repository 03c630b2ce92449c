"""Hourly observation series on Spark: ingest, features, training, drift."""
