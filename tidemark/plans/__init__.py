"""Derived tables: the denormalized order line and the daily sales."""
