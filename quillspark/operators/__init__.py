"""Relational operators: deduplication, rules, scoring, rollups."""
