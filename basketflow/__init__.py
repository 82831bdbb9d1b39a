"""Batch analytics for retail transactions, written as plain PySpark DataFrame functions."""
