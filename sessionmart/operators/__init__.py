"""Reusable relational operators: session windows, aggregates, joins, checks."""
