"""Batch plans for the current-state tables: whole log in, table out.

The ``*_state`` functions compute a table from a whole log in one plan (backfill);
the ``*_merge`` functions apply one micro-batch of parsed events to the current
rows. A batch loop over ``*_merge`` ends at what ``*_state`` gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.envelope import META, parse_envelope
from tidemark.functions.rules import customer_rule, order_rule
from tidemark.functions.scalars import event_date, is_delete
from tidemark.operators.changefeed import change_history
from tidemark.operators.dedupe import delete_wins_order, latest_or_rejected, latest_per_key, latest_two, stream_order
from tidemark.operators.merge import Delete, Insert, Merged, StateMerged, Update, apply_merge, merge_latest
from tidemark.operators.neighbours import SLICE
from tidemark.schemas import CUSTOMERS, DELETE_OP, FACT_ORDERS, ORDERS, POSITION, UPSERT_OPS, CdcTableSpec

FACT_COLUMNS = tuple(FACT_ORDERS.fieldNames())
SILVER_INPUT = ("op", "ts_ms", *CUSTOMERS.columns)
FACT_INPUT = ("op", "ts_ms", *ORDERS.columns, "event_date")
HIDDEN = tuple(POSITION.fieldNames())
LIVE = "NOT coalesce(_deleted, false)"
IS_DELETE = f"s.op = '{DELETE_OP}'"
IS_UPSERT = f"s.op IN ({', '.join(repr(o) for o in UPSERT_OPS)})"


def topic_events(
    bronze: DataFrame, spec: CdcTableSpec, prefix: str = "shop", keep: tuple[str, ...] = META,
) -> DataFrame:
    """Parsed events of one captured table; the topic filter prunes bronze folders."""
    return parse_envelope(bronze.where(F.col("topic") == spec.topic(prefix)), spec, keep)


def customer_events(bronze: DataFrame, prefix: str = "shop", **kw) -> DataFrame:
    return topic_events(bronze, CUSTOMERS, prefix, **kw)


def order_events(bronze: DataFrame, prefix: str = "shop", tz: str | None = "UTC", **kw) -> DataFrame:
    parsed = topic_events(bronze, ORDERS, prefix, **kw)
    return parsed.withColumn("event_date", event_date(F.col("ts_ms"), tz))


def keyed(customers: DataFrame) -> DataFrame:
    """The dimension drops key-less events before it validates, so they are never
    quarantined there."""
    return customers.where(F.col("customer_id").isNotNull())


# --- silver customers -------------------------------------------------------

def silver_state(valid: DataFrame) -> DataFrame:
    latest = latest_per_key(valid, ["customer_id"], stream_order(), SILVER_INPUT)
    live = latest.where(~is_delete(F.col("op")))
    return live.select("customer_id", *CUSTOMERS.attrs, F.col("ts_ms").alias("_last_ts_ms"))


def _position() -> list[Column]:
    """The hidden columns of an event."""
    return [
        F.col("kafka_partition").cast("int").alias("_partition"), F.col("kafka_offset").cast("bigint").alias("_offset"),
        is_delete(F.col("op")).alias("_deleted"),
    ]


def _place() -> list[Column]:
    # As in stream_order: rows without position lose against rows that have one.
    return [F.coalesce(F.col("_partition"), F.lit(-1)), F.coalesce(F.col("_offset"), F.lit(-1))]


def silver_batch(events: DataFrame) -> DataFrame:
    """What the customers keep of a micro-batch: the latest valid event per key, and every rejected one."""
    return latest_or_rejected(events, customer_rule(), ["customer_id"], stream_order())


def fact_batch(events: DataFrame) -> DataFrame:
    """The same for orders."""
    return latest_or_rejected(events, order_rule(), ["order_id"], delete_wins_order())


def silver_merge_ordered(state: DataFrame, valid: DataFrame, unique: bool = False) -> StateMerged:
    """Apply a micro-batch to the customers with tombstones; the latest event in stream
    order wins, so the cut into micro-batches and their order do not matter. ``unique`` says
    that ``valid`` holds one row per key."""
    latest = valid if unique else latest_per_key(valid, ["customer_id"], stream_order(), [*SILVER_INPUT, "kafka_partition", "kafka_offset"])
    rows = latest.select("customer_id", *CUSTOMERS.attrs, F.col("ts_ms").alias("_last_ts_ms"), *_position())
    return merge_latest(state, rows, "customer_id", [F.col("_last_ts_ms"), *_place()], "_deleted", HIDDEN)


def fact_merge_ordered(state: DataFrame, valid: DataFrame, unique: bool = False) -> StateMerged:
    """The same for orders, in whose order a delete wins among events of one time."""
    latest = valid if unique else latest_per_key(valid, ["order_id"], delete_wins_order(), [*FACT_INPUT, "kafka_partition", "kafka_offset"])
    rows = latest.select(
        *[F.col("ts_ms").alias(c) if c == "event_ts_ms" else F.col(c) for c in FACT_COLUMNS], *_position(),
    )
    order = [F.col("event_ts_ms"), F.coalesce(F.col("_deleted"), F.lit(False)).cast("int"), *_place()]
    return merge_latest(state, rows, "order_id", order, "_deleted", HIDDEN)


def silver_merge(target: DataFrame, valid: DataFrame, guard: str | None = None) -> Merged:
    """Apply one micro-batch of valid events to the current customers, without tombstones.

    By default the later batch wins whatever its event time (arrival order).
    ``guard="event_time"`` leaves a row alone when the event is older than it; a
    deleted customer has no row to compare with, so an older upsert revives it.
    """
    if guard not in (None, "event_time"):
        raise ValueError(f"unknown guard {guard!r}")
    newer = "" if guard is None else " AND coalesce(s.ts_ms >= t._last_ts_ms, true)"
    values = {**{a: f"s.{a}" for a in CUSTOMERS.attrs}, "_last_ts_ms": "s.ts_ms"}
    return apply_merge(
        target, latest_per_key(valid, ["customer_id"], stream_order(), SILVER_INPUT), ["customer_id"],
        matched=[
            Delete(when=f"{IS_DELETE}{newer}"),
            Update(values, when=f"{IS_UPSERT}{newer}"),
        ],
        not_matched=[Insert({"customer_id": "s.customer_id", **values}, when=IS_UPSERT)],
        source_unique=True,
    )


# --- fact orders ------------------------------------------------------------

def fact_state(valid: DataFrame) -> DataFrame:
    latest = latest_per_key(valid, ["order_id"], delete_wins_order(), FACT_INPUT)
    live = latest.where(~is_delete(F.col("op")))
    return live.select(*[F.col("ts_ms").alias(c) if c == "event_ts_ms" else F.col(c) for c in FACT_COLUMNS])


def fact_states(valid: DataFrame, earlier: Column) -> DataFrame:
    """(order_id, before, now): the fact of the earlier events and that of all, side by side off one aggregate.

    An order that is not there is NULL on that side.
    """
    both = latest_two(valid, ["order_id"], delete_wins_order(), earlier, FACT_INPUT)
    row = lambda side: F.struct(*[F.col(f"{side}.{'ts_ms' if c == 'event_ts_ms' else c}").alias(c) for c in FACT_COLUMNS])
    live = lambda side: F.when(F.col(side).isNotNull() & ~is_delete(F.col(f"{side}.op")), row(side))
    return both.select("order_id", live("before").alias("before"), live("now").alias("now"))


def fact_merge(target: DataFrame, valid: DataFrame, guard: str | None = None) -> Merged:
    """Apply one micro-batch of valid order events; a row may move to another day."""
    if guard not in (None, "event_time"):
        raise ValueError(f"unknown guard {guard!r}")
    newer = "" if guard is None else " AND coalesce(s.ts_ms >= t.event_ts_ms, true)"
    values = {
        "customer_id": "s.customer_id", "order_status": "s.order_status",
        "event_ts_ms": "s.ts_ms", "event_date": "s.event_date",
    }
    return apply_merge(
        target, latest_per_key(valid, ["order_id"], delete_wins_order(), FACT_INPUT), ["order_id"],
        matched=[
            Delete(when=f"{IS_DELETE}{newer}"),
            Update(values, when=f"{IS_UPSERT}{newer}"),
        ],
        not_matched=[Insert({"order_id": "s.order_id", **values}, when=IS_UPSERT)],
        source_unique=True,
    )


def fact_changes(valid: DataFrame, batch: str, slice_width: int | None = SLICE) -> DataFrame:
    """Change rows of all micro-batches in one plan (``_commit_version`` = batch)."""
    winners = latest_per_key(valid, [batch, "order_id"], delete_wins_order(), [batch, *FACT_INPUT])
    winners = winners.withColumn("event_ts_ms", F.col("ts_ms")).select(batch, "op", *FACT_COLUMNS)
    return change_history(winners, ["order_id"], FACT_COLUMNS, batch, slice_width)

