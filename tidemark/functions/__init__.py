"""Column-level building blocks: envelope parsing, casts, validity rules."""
