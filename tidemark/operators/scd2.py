"""Type-2 history: close the current version, open the next one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import attrs_differ, is_delete, is_upsert
from tidemark.operators.dedupe import delete_wins_order, latest_per_key
from tidemark.operators.merge import Update, apply_merge
from tidemark.operators.neighbours import SLICE, with_neighbours
from tidemark.schemas import CUSTOMERS, DELETE_OP, UPSERT_OPS, CdcTableSpec

START, END, CURRENT = "effective_start_ts_ms", "effective_end_ts_ms", "is_current"


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.where(F.col(CURRENT))


def compare_with_current(dim: DataFrame, batch: DataFrame, spec: CdcTableSpec = CUSTOMERS) -> DataFrame:
    """Batch rows (one per key) beside their current version, columns prefixed ``t_``.

    Adds ``has_current``, ``differs`` (an attribute that turns from NULL to the empty
    string does not differ) and ``known``: a version starting at the row's time is
    there already, so the event is a replay.

    The dimension is read once and joined to the batch, the side Spark may broadcast. Only
    a key's current version and the one that starts at the row's time pass the join, so
    the long history of one key does not meet. Two current versions of a key raise.
    """
    key = spec.keys[0]
    sought = batch.select(F.col(key), F.col("ts_ms").alias("_at"))
    current, starts = F.coalesce(F.col(CURRENT), F.lit(False)), F.col(START).eqNullSafe(F.col("_at"))
    seen = dim.join(sought, key).where(current | starts).groupBy(key).agg(
        F.max(F.when(current, F.struct(*spec.attrs))).alias("_current"), F.max(starts).alias("_known"), F.count_if(current).alias("_many"),
    )
    beside = batch.join(seen, key, "left")
    two = F.raise_error(F.concat(F.lit("several current versions of "), F.col(key).cast("string")))
    return beside.select(
        *batch.columns, *[F.col(f"_current.{a}").alias(f"t_{a}") for a in spec.attrs],
        F.when(F.col("_many") > 1, two.cast("boolean")).otherwise(F.col("_current").isNotNull()).alias("has_current"),
        attrs_differ([F.col(a) for a in spec.attrs], [F.col(f"_current.{a}") for a in spec.attrs])
        .alias("differs"),
        F.coalesce(F.col("_known"), F.lit(False)).alias("known"),
    )


def close_set(compared: DataFrame, spec: CdcTableSpec = CUSTOMERS) -> DataFrame:
    """Keys whose current version ends, and when: deletes and changed upserts."""
    ends = is_delete(F.col("op")) | (is_upsert(F.col("op")) & F.col("has_current") & F.col("differs"))
    return compared.where(ends).select(spec.keys[0], "ts_ms")


def open_set(compared: DataFrame, spec: CdcTableSpec = CUSTOMERS) -> DataFrame:
    """New versions: upserts of new keys and changed upserts."""
    begins = is_upsert(F.col("op")) & (~F.col("has_current") | F.col("differs"))
    return compared.where(begins).select(
        spec.keys[0], *spec.attrs, F.col("ts_ms").alias(START),
        F.lit(None).cast("bigint").alias(END), F.lit(True).alias(CURRENT),
    )


def close_versions(dim: DataFrame, closing: DataFrame, spec: CdcTableSpec = CUSTOMERS) -> DataFrame:
    """End the current versions named in ``closing`` (one row per key); one join."""
    return apply_merge(
        dim, closing, spec.keys, source_unique=True,
        matched=[Update({END: "s.ts_ms", CURRENT: "false"}, when=f"t.{CURRENT}")],
    ).rows()


def open_versions(dim: DataFrame, compared: DataFrame, spec: CdcTableSpec = CUSTOMERS) -> DataFrame:
    """Add the new versions whose (key, start) is not there yet, so a replay adds nothing."""
    return dim.unionByName(open_set(compared.where("NOT known"), spec))


def scd2_batch(dim: DataFrame, batch: DataFrame, spec: CdcTableSpec = CUSTOMERS) -> DataFrame:
    """The dimension after one micro-batch of valid rows.

    The batch is cut to its latest row per key, deletes winning ties. A batch that
    opens nothing is fine, and replaying one adds nothing.
    """
    key = spec.keys[0]
    latest = latest_per_key(batch, [key], delete_wins_order(), ["op", "ts_ms", key, *spec.attrs])
    compared = compare_with_current(dim, latest, spec)
    return open_versions(close_versions(dim, close_set(compared, spec), spec), compared, spec)


def scd2_history(
    events: DataFrame, batch: str, spec: CdcTableSpec = CUSTOMERS, collapse: str = "batch",
    slice_width: int | None = SLICE,
) -> DataFrame:
    """The dimension after all micro-batches, as one plan instead of a loop.

    ``collapse="batch"`` keeps one row per key and micro-batch, as the batch loop
    does. With ``collapse="none"`` every event counts, in arrival order (each event
    its own batch). Batches, or offsets, are sliced so that the history of a hot
    key spreads over many tasks (see ``with_neighbours``).

    Equal to the loop when event time does not run backwards from batch to batch
    within a key; a late event would close versions before they start there.
    """
    key = spec.keys[0]
    if collapse == "batch":
        kept = [key, batch, "op", "ts_ms", *spec.attrs]
        rows, order = latest_per_key(events, [batch, key], delete_wins_order(), kept), batch
    elif collapse == "none":
        rows, order = events, "kafka_offset"
    else:
        raise ValueError(f"unknown collapse mode {collapse!r}")
    rows = rows.select(key, order, "op", "ts_ms", *spec.attrs)
    return versions(rows, spec, order, slice_width)


def versions(
    rows: DataFrame, spec: CdcTableSpec, order: str | Sequence[Column], slice_width: int | None, axis: Column | None = None,
) -> DataFrame:
    """The versions that (key, op, ts_ms, attributes) in this order make, in one pass over the rows."""
    key = spec.keys[0]
    turns = with_neighbours(
        rows, [key], order, slice_width=slice_width, among=boundary(spec), axis=axis,
        previous={"_old_op": "op", **{f"_old_{a}": a for a in spec.attrs}}, following={"_next_ts": "ts_ms", "_next_op": "op"},
    )
    return turns.where(F.col("_among") & ~is_delete(F.col("op"))).select(
        key, *spec.attrs, F.col("ts_ms").alias(START), F.col("_next_ts").alias(END), F.col("_next_op").isNull().alias(CURRENT),
    )


def boundary(spec: CdcTableSpec) -> Column:
    """Whether a row starts or ends a version, beside the previous row (``_old_op``, ``_old_<attribute>``).

    A no-change upsert leaves equal attributes, so the previous row stands for the live version.
    """
    lived = F.coalesce(~is_delete(F.col("_old_op")), F.lit(False))
    differs = attrs_differ([F.col(a) for a in spec.attrs], [F.col(f"_old_{a}") for a in spec.attrs])
    return F.when(is_delete(F.col("op")), lived).otherwise(~lived | differs)


# --- history that takes late events -----------------------------------------------

#: A state row is an event; ``_opens`` says whether it starts a version readers see.
OPENS = "_opens"
_EARLIEST = -(1 << 63)
#: Milliseconds of event time that one task takes of a key: fifty days.
TIME_SLICE = 1 << 32
#: Rows of a key up to which one task takes the key whole.
FEW = 1 << 18


def _event_order() -> list[Column]:
    """Event time, deletes last among equal times, then arrival: ``delete_wins_order`` read forwards."""
    return [F.col("ts_ms"), is_delete(F.col("op")).cast("int"), F.coalesce("_partition", F.lit(-1)), F.coalesce("_offset", F.lit(-1))]


def history_state(events: DataFrame, spec: CdcTableSpec = CUSTOMERS, slice_ms: int | None = TIME_SLICE) -> DataFrame:
    """Every event of (key, attributes, op, ts_ms, _partition, _offset) as a state row, in event order.

    Repeated events count once. Events that change nothing are kept, unseen: an event that
    comes in before one of them can make it a boundary.
    """
    key = spec.keys[0]
    rows = with_neighbours(
        events.select(key, "op", "ts_ms", "_partition", "_offset", *spec.attrs), [key], _event_order(), slice_width=slice_ms,
        among=boundary(spec), axis=F.coalesce("ts_ms", F.lit(_EARLIEST)),
        once=[F.col(c) for c in ("op", "_partition", "_offset")], best=F.struct(*spec.attrs),
        previous={"_old_op": "op", **{f"_old_{a}": a for a in spec.attrs}}, following={"_next_ts": "ts_ms", "_next_op": "op"},
    )
    opens = F.col("_among") & ~is_delete(F.col("op"))
    return rows.select(
        key, *spec.attrs, F.col("ts_ms").alias(START), F.when(opens, F.col("_next_ts")).alias(END), (opens & F.col("_next_op").isNull()).alias(CURRENT),
        "_partition", "_offset", is_delete(F.col("op")).alias("_deleted"), opens.alias(OPENS),
    )


def slice_for(state: DataFrame, batch: DataFrame, spec: CdcTableSpec = CUSTOMERS, few: int = FEW) -> int | None:
    """What to cut keys by for ``history_merge`` (one count, run at once): nothing, unless a key has more than ``few`` rows.

    Whole keys save a second reading of the rows and the join with the summaries of slices.
    """
    key = spec.keys[0]
    many = state.select(key).unionByName(batch.select(key)).groupBy(key).count().where(F.col("count") > few)
    return None if many.isEmpty() else TIME_SLICE


def history_merge(state: DataFrame, batch: DataFrame, spec: CdcTableSpec = CUSTOMERS, slice_ms: int | None = TIME_SLICE) -> DataFrame:
    """The state after a batch of valid events, whatever order batches come in.

    A late event cuts the version it falls into; versions that come to start with no change
    go, and ends move. Only what a key has from the version around its earliest new event on
    is worked out again: events in order touch current versions only, however long a history is.
    Any cut of a log into batches, in any order and with repeats, ends at ``history_state`` of the log.
    """
    key = spec.keys[0]
    columns = [key, *spec.attrs, "op", "ts_ms", "_partition", "_offset"]
    fresh = batch.withColumns({"_partition": F.col("kafka_partition").cast("int"), "_offset": F.col("kafka_offset").cast("bigint")}).select(*columns)
    since = fresh.groupBy(key).agg(F.min(F.coalesce("ts_ms", F.lit(_EARLIEST))).alias("_since"))
    at = lambda c: F.coalesce(F.col(c), F.lit(_EARLIEST))
    # The version around the earliest new event, all that starts later, and unseen events from then on.
    open_ = F.when(F.col(OPENS), F.col(CURRENT) | (at(END) >= F.col("_since"))).otherwise(at(START) >= F.col("_since"))
    beside = state.join(since, key, "left").withColumn("_again", F.col("_since").isNotNull() & open_)
    again = beside.where("_again").withColumns({"op": F.when(F.col("_deleted"), DELETE_OP).otherwise(UPSERT_OPS[1]), "ts_ms": F.col(START)})
    # The kind of upsert plays no part in a history.
    fresh = fresh.withColumn("op", F.when(is_delete(F.col("op")), F.col("op")).otherwise(UPSERT_OPS[1]))
    redone = history_state(again.select(*columns).unionByName(fresh), spec, slice_ms)
    return beside.where("NOT _again").select(*state.columns).unionByName(redone.select(*state.columns))
