"""Warehouse builders, reports and the two runs (bulk load, month)."""
