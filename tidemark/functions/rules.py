"""Validity rules and the valid / rejected split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import is_delete, is_upsert

# Fixed value: two upper-case letters.
STATE_PATTERN = "^[A-Z]{2}$"


def customer_rule() -> Column:
    """Deletes need a key; upserts need a key and a two-letter state."""
    key = F.col("customer_id").isNotNull()
    return (is_delete(F.col("op")) & key) | (
        is_upsert(F.col("op")) & key & F.col("customer_state").rlike(STATE_PATTERN)
    )


def order_rule() -> Column:
    """Deletes need the order key; upserts need order and customer key."""
    key = F.col("order_id").isNotNull()
    return (is_delete(F.col("op")) & key) | (
        is_upsert(F.col("op")) & key & F.col("customer_id").isNotNull()
    )


def split_valid(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rows that do not). An undecided rule (NULL) rejects.

    The rejected side is the bag difference of input and valid rows, duplicates
    kept, but as a plain filter: no shuffle.
    """
    passes = F.coalesce(rule, F.lit(False))
    return df.where(passes), df.where(~passes)
