"""Tidemark: listing-lifecycle analytics and training-data operators on PySpark."""
