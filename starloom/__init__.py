"""Dimensional warehouse operators expressed as Spark DataFrame transformations."""
