"""Retail-sales warehouse and reporting on Spark."""
