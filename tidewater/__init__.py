"""Layered retail and logistics warehouse operators on PySpark."""
