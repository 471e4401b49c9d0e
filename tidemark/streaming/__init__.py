"""Structured Streaming jobs; each micro-batch calls the batch operators."""
