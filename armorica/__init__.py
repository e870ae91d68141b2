"""Territorial statistics as PySpark DataFrame operators and batch plans."""
