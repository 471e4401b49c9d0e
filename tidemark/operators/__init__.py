"""Relational operators: dedupe, merge, type-2 history, change feed, checks."""
