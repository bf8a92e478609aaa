"""Batch customer and sales analytics as lazy PySpark DataFrame operators."""
