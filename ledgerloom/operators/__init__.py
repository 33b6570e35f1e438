"""Relational operators: linking, merging, upserts, scoring."""
