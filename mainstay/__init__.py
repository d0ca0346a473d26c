"""Renewal analytics for buried linear assets, written as PySpark DataFrame operators."""
