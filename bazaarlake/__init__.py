"""Marketplace-listing analytics as plain PySpark DataFrame, streaming and ML jobs."""
