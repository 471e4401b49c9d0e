"""From change rows to incrementally kept counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import change_sign, is_delete
from tidemark.operators.merge import Insert, Merged, Update, apply_merge
from tidemark.operators.neighbours import SLICE, with_neighbours
from tidemark.schemas import DELETE, INSERT, UPDATE_AFTER, UPDATE_BEFORE

GROUP = ("event_date", "order_status")


def change_history(
    winners: DataFrame, keys: Sequence[str], columns: Sequence[str], batch: str,
    slice_width: int | None = SLICE,
) -> DataFrame:
    """All change rows that merging the batches one after another would emit.

    ``winners`` holds one row per (key, batch) with ``op``; ``columns`` are the
    target's. Instead of looping over batches, each winner is set beside the
    previous winner of its key: that is the row a merge would have found (or none,
    if it was a delete).
    """
    beside = with_neighbours(
        winners, keys, batch, slice_width=slice_width,
        previous={"_old_op": "op", **{f"_old_{c}": c for c in columns}},
    )
    lived = F.coalesce(~is_delete(F.col("_old_op")), F.lit(False))
    lives = ~is_delete(F.col("op"))

    def row(prefix: str, kind: str):
        return F.struct(
            *[F.col(prefix + c).alias(c) for c in columns],
            F.lit(kind).alias("_change_type"), F.col(batch).alias("_commit_version"),
        )

    emitted = (
        F.when(lived & lives, F.array(row("_old_", UPDATE_BEFORE), row("", UPDATE_AFTER)))
        .when(lived, F.array(row("_old_", DELETE)))
        .when(lives, F.array(row("", INSERT)))
    )
    return beside.select(F.inline(emitted))


def deltas(changes: DataFrame, group: Sequence[str] = GROUP, drop_zero: str = "after") -> DataFrame:
    """Net count change per group.

    ``drop_zero="before"`` drops rows of unknown kind and keeps groups whose
    changes cancel out; ``"after"`` drops the cancelled groups as well.
    """
    signed = changes.select(*group, change_sign(F.col("_change_type")).alias("_sign"))
    if drop_zero == "before":
        signed = signed.where("_sign <> 0")
    summed = signed.groupBy(*group).agg(F.sum("_sign").alias("delta_cnt"))
    return summed.where("delta_cnt <> 0") if drop_zero == "after" else summed


def merge_deltas(counts: DataFrame, delta: DataFrame, group: Sequence[str] = GROUP) -> Merged:
    """Add deltas to the kept counts. NULL groups match (an addition is not lost
    or repeated because a status is unknown); groups that fall to 0 stay."""
    return apply_merge(
        counts, delta, group,
        matched=[Update({"order_cnt": "t.order_cnt + s.delta_cnt"})],
        not_matched=[Insert({**{g: f"s.{g}" for g in group}, "order_cnt": "s.delta_cnt"})],
        null_safe=True, source_unique=True,
    )


def counts_after(merged: Merged, group: Sequence[str] = GROUP) -> DataFrame:
    """Counts of the target before a merge, kept up by the merge's changes: both read off its one join.

    The same as ``merge_deltas`` of the old counts and the merge's ``deltas``: groups that
    fall to 0 stay, and changes that cancel out add no group.
    """
    act = F.col("_act")

    def row(image: str, seed: int, delta: int):
        return F.struct(*[F.col(f"{image}.{c}").alias(c) for c in group], F.lit(seed).cast("bigint").alias("_seed"), F.lit(delta).cast("bigint").alias("_delta"))

    emitted = (
        F.when(act == "keep", F.array(row("_before", 1, 0))).when(act == "delete", F.array(row("_before", 1, -1)))
        .when(act == "insert", F.array(row("_after", 0, 1))).when(act == "update", F.array(row("_before", 1, -1), row("_after", 0, 1)))
    )
    summed = merged.joined.select(F.inline(emitted)).groupBy(*group).agg(F.sum("_seed").alias("_seed"), F.sum("_delta").alias("_delta"))
    return summed.where("_seed > 0 OR _delta <> 0").select(*group, (F.col("_seed") + F.col("_delta")).alias("order_cnt"))
