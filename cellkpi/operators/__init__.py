"""Relational operators: enrichment join, spec aggregation, partition selection."""
