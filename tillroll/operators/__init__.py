"""Relational operators: cleaning, enrichment, joins, aggregates, ranking, quality."""
