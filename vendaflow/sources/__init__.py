"""Readers that return the flat sales table."""
