"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import is_delete


def _arrival() -> list[Column]:
    # Rows without position (older files) lose ties against rows that have one.
    return [
        F.coalesce(F.col("kafka_partition"), F.lit(-1)),
        F.coalesce(F.col("kafka_offset"), F.lit(-1)),
    ]


def stream_order() -> list[Column]:
    """Newest event time, then highest partition, then highest offset."""
    return [F.col("ts_ms"), *_arrival()]


def delete_wins_order() -> list[Column]:
    """Newest event time, then deletes before upserts, then arrival."""
    return [F.col("ts_ms"), is_delete(F.col("op")).cast("int"), *_arrival()]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column],
    columns: Sequence[str] | None = None, method: str = "max_by",
) -> DataFrame:
    """One row per key: the greatest by ``order``; NULL sorts last.

    Both methods cut each key to one row per input partition before the shuffle
    (partial aggregate, or a partial group limit under the window), so a key that
    holds a third of the rows never meets in one task. ``columns`` are the ones to
    keep (default: all); only they and the order travel.
    """
    columns = list(columns or df.columns)
    if method == "max_by":
        rest = [c for c in columns if c not in keys]
        rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
        flat = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_best"))
        return flat.selectExpr(*[f"`{c}`" if c in keys else f"_best.`{c}`" for c in columns])
    if method == "row_number":
        window = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])
        return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").select(*columns)
    raise ValueError(f"unknown dedupe method {method!r}")


def latest_or_rejected(df: DataFrame, rule: Column, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of the rows that pass ``rule`` the latest per key, and every row that does not, by one aggregate.

    A rejected row is a group of its own, so equal ones all stay and none meet in one task. Read
    once, this is what a micro-batch has to keep of its rows for a merge by key and the quarantine.
    """
    passes = F.coalesce(rule, F.lit(False))
    placed = df.withColumn("_alone", F.when(~passes, F.monotonically_increasing_id()))
    return latest_per_key(placed, [*keys, "_alone"], order).select(*df.columns)


def latest_two(df: DataFrame, keys: Sequence[str], order: Sequence[Column], earlier: Column, columns: Sequence[str]) -> DataFrame:
    """Per key the latest row of all (``now``) and the latest of those that meet ``earlier`` (``before``), by one aggregate."""
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    row = F.struct(*columns)
    return df.groupBy(*keys).agg(F.max_by(row, rank).alias("now"), F.max_by(row, F.when(earlier, rank)).alias("before"))
