"""Warehouse, star queries and reports."""
