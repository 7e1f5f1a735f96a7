"""Operators for a training-data pipeline, each a Spark job on its own."""
