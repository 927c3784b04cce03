"""Retail markdown analytics as PySpark DataFrame functions."""
