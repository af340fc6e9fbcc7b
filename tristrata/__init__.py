"""Medallion analytics as plain PySpark DataFrame functions."""
