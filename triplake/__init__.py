"""Batch trip lakehouse on PySpark: bronze files to a revenue mart."""
