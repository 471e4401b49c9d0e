"""Row inserts and conditional updates on a table's current rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import INSERT, UPDATE_AFTER, UPDATE_BEFORE


def insert_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append ``rows``, matched by name and cast to the table's types; no dedupe."""
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields])
    return table.unionByName(typed)


def insert_changes(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_change_type", F.lit(INSERT))


def update_where(table: DataFrame, condition: str, assignments: dict[str, str]) -> DataFrame:
    """Set columns to SQL expressions where the condition is true; all see the old row."""
    hit = F.coalesce(F.expr(condition), F.lit(False))
    return table.select(*[_assigned(f, assignments, hit) for f in table.schema.fields])


def update_changes(table: DataFrame, condition: str, assignments: dict[str, str]) -> DataFrame:
    """The before and after rows of ``update_where``, for the rows it touches."""
    old = F.struct(*table.columns, F.lit(UPDATE_BEFORE).alias("_change_type"))
    new = F.struct(
        *[_assigned(f, assignments, F.lit(True)) for f in table.schema.fields],
        F.lit(UPDATE_AFTER).alias("_change_type"),
    )
    return table.where(condition).select(F.inline(F.array(old, new)))


def _assigned(field, assignments: dict[str, str], hit: Column) -> Column:
    if field.name not in assignments:
        return F.col(field.name)
    value = F.expr(assignments[field.name]).cast(field.dataType)
    return F.when(hit, value).otherwise(F.col(field.name)).alias(field.name)
