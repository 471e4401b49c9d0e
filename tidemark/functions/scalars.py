"""Scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import DELETE, DELETE_OP, INSERT, UPDATE_AFTER, UPDATE_BEFORE, UPSERT_OPS


def try_bigint(text: Column) -> Column:
    """Text to bigint: junk gives NULL, a fraction is cut off. Never raises under ANSI."""
    whole = F.regexp_replace(text, r"^(\s*[+-]?\d+)\.\d*(\s*)$", "$1$2")
    return F.coalesce(text.try_cast("bigint"), whole.try_cast("bigint"))


def ntz_from_micros(micros: Column) -> Column:
    """Epoch microseconds to a zone-free timestamp, whatever the session zone."""
    seconds = (micros / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def event_date(ts_ms: Column, tz: str | None = "UTC") -> Column:
    """Calendar day of an epoch-millisecond value in ``tz`` (None: the session zone).

    Milliseconds are cut toward zero before the day is taken. UTC days are plain
    integer arithmetic; other zones go through zone-free timestamps, so only
    ``tz=None`` depends on the session.
    """
    seconds = F.call_function("div", ts_ms, F.lit(1000).cast("bigint"))
    if tz is None:
        return F.to_date(F.timestamp_seconds(seconds))
    if tz.upper() == "UTC":
        return F.date_from_unix_date(F.floor(seconds / F.lit(86400)).cast("int"))
    utc = ntz_from_micros(seconds * F.lit(1_000_000))
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), utc))


def is_delete(op: Column) -> Column:
    return op == F.lit(DELETE_OP)


def is_upsert(op: Column) -> Column:
    return op.isin(*UPSERT_OPS)


def attrs_differ(left: Iterable[Column], right: Iterable[Column]) -> Column:
    """True where any pair of text columns differs; NULL counts as the empty string."""
    changed = F.lit(False)
    for a, b in zip(left, right, strict=True):
        changed = changed | (F.coalesce(a, F.lit("")) != F.coalesce(b, F.lit("")))
    return changed


def change_sign(change_type: Column) -> Column:
    """What one change row adds to a count: +1, -1, or 0 for an unknown kind."""
    return (
        F.when(change_type.isin(INSERT, UPDATE_AFTER), F.lit(1))
        .when(change_type.isin(DELETE, UPDATE_BEFORE), F.lit(-1))
        .otherwise(F.lit(0))
        .cast("bigint")
    )
