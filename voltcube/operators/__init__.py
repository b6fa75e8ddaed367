"""Reusable DataFrame operators (grouping, windows, joins, reshaping, name
resolution, checks, additivity-aware aggregation)."""
