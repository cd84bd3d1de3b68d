"""Relational building blocks: keyed aggregates, joins, sequence features, checks."""
