"""Batch plans that put the operators together, table by table."""
