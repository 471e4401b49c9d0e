"""Merge a source into a target by key: delete, update, insert, change rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import DELETE, INSERT, UPDATE_AFTER, UPDATE_BEFORE

Values = dict[str, str]


class MergeConflict(Exception):
    """More than one source row would change the same target row."""


@dataclass(frozen=True)
class Delete:
    """Matched rows that meet ``when`` leave the target."""

    when: str = "true"


@dataclass(frozen=True)
class Update:
    """Matched rows that meet ``when`` take ``set`` (None: every source column)."""

    set: Values | None = None
    when: str = "true"


@dataclass(frozen=True)
class Insert:
    """Unmatched source rows that meet ``when`` are added (None: every source column)."""

    values: Values | None = None
    when: str = "true"


@dataclass(frozen=True)
class Merged:
    """The joined rows of a merge; both results are read off the same join."""

    joined: DataFrame
    columns: tuple[str, ...]

    def persist(self) -> Merged:
        """Join once for rows and changes; ``joined.unpersist()`` when both are written."""
        return replace(self, joined=self.joined.persist(StorageLevel.MEMORY_AND_DISK))

    def rows(self) -> DataFrame:
        """The target after the merge."""
        kept = self.joined.where(F.col("_act").isin("keep", "update", "insert"))
        return kept.select(*[F.col(f"_after.{c}").alias(c) for c in self.columns])

    def changes(self) -> DataFrame:
        """One row per insert or delete, a before and an after row per update."""
        act = F.col("_act")

        def row(image: str, kind: str) -> Column:
            values = [F.col(f"{image}.{c}").alias(c) for c in self.columns]
            return F.struct(*values, F.lit(kind).alias("_change_type"))

        emitted = (
            F.when(act == "insert", F.array(row("_after", INSERT)))
            .when(act == "delete", F.array(row("_before", DELETE)))
            .otherwise(F.array(row("_before", UPDATE_BEFORE), row("_after", UPDATE_AFTER)))
        )
        # Asking for a source row turns the full join into one that keeps source rows only.
        hit = self.joined.where(F.col("_hit").isNotNull() & act.isin("insert", "delete", "update"))
        return hit.select(F.inline(emitted))


@dataclass(frozen=True)
class StateMerged(Merged):
    """A merge of tombstoned state: ``rows`` has the hidden columns, ``changes`` only what readers see."""

    def rows(self) -> DataFrame:
        return self.joined.select("_state.*")


def merge_latest(
    state: DataFrame, latest: DataFrame, key: str, order: Sequence[Column], deleted: str, hidden: Sequence[str],
) -> StateMerged:
    """Per key the later of the stored row and the new one, whatever order batches come in.

    Both sides have the same columns and one row per key; ``order`` (columns of either
    side, NULL first) is a total order of a key's events. A delete stays as a row with
    ``deleted`` set. One full join; equal rows, as in a replay, change nothing.
    """
    columns = tuple(state.columns)
    visible = tuple(c for c in columns if c not in hidden)
    stamp = F.struct(*order)
    t = state.select(F.struct(*columns).alias("_t"), F.col(key).alias("_key"), stamp.alias("_t_order"))
    s = latest.select(F.struct(*columns).alias("_s"), F.col(key).alias("_key"), stamp.alias("_s_order"))
    gone = lambda side: F.coalesce(F.col(f"{side}.{deleted}"), F.lit(False))
    newer = F.col("_s").isNotNull() & (F.col("_t").isNull() | (F.col("_s_order") > F.col("_t_order")))
    lived, lives = F.col("_t").isNotNull() & ~gone("_t"), ~gone("_s")
    act = (
        F.when(newer & lived & lives, "update").when(newer & lived, "delete").when(newer & lives, "insert").otherwise("keep")
    )
    seen = lambda side: F.struct(*[F.col(f"{side}.{c}").alias(c) for c in visible])
    joined = t.join(s, "_key", "full_outer").select(
        act.alias("_act"), F.col("_s").isNotNull().alias("_found"), seen("_t").alias("_before"), seen("_s").alias("_after"),
        F.when(newer, F.col("_s")).otherwise(F.col("_t")).alias("_state"),
    )
    return StateMerged(joined.withColumn("_hit", F.when(F.col("_found"), F.lit(True))).drop("_found"), visible)


def apply_merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched: Sequence[Delete | Update] = (),
    not_matched: Sequence[Insert] = (),
    null_safe: bool = False,
    source_unique: bool = False,
) -> Merged:
    """Merge by equality on ``on``; clauses are SQL over the aliases ``t`` and ``s``.

    Clauses are tried in order and the first that fits wins. Target rows nothing
    fits stay; unmatched source rows nothing fits are dropped. ``null_safe`` lets
    NULL keys match each other.

    One equi-join does it all: full outer when rows can be inserted, else left
    outer, which leaves a small source free to be broadcast. ``source_unique`` says
    the source holds one row per key (any output of ``latest_per_key``); otherwise
    the source is checked, and the merge raises if two of its rows would change
    one target row.
    """
    columns = tuple(target.columns)
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    equals = "<=>" if null_safe else "="
    on_keys = " AND ".join(f"t.`{key}` {equals} s.`{key}`" for key in on)
    joined = t.join(s, F.expr(on_keys), "full_outer" if not_matched else "left_outer")

    # (condition, kind of action, new values) in the order in which clauses are tried.
    clauses: list[tuple[str, str, Values]] = []
    for clause in matched:
        when = f"t._in_target AND s._in_source AND ({clause.when})"
        if isinstance(clause, Delete):
            clauses.append((when, "delete", {}))
        else:
            clauses.append((when, "update", _values(clause.set, columns)))
    for clause in not_matched:
        when = f"s._in_source AND t._in_target IS NULL AND ({clause.when})"
        clauses.append((when, "insert", _values(clause.values, columns)))

    def case(results: Sequence[str], otherwise: str) -> str:
        branches = " ".join(f"WHEN {c[0]} THEN {r}" for c, r in zip(clauses, results, strict=True))
        return f"CASE {branches} ELSE {otherwise} END" if branches else otherwise

    act = case([f"'{kind}'" for _, kind, _ in clauses], "CASE WHEN t._in_target THEN 'keep' ELSE 'drop' END")
    after = []
    for field in target.schema.fields:
        kind_of = field.dataType.simpleString()
        given = [
            f"cast({values.get(field.name, 'NULL' if kind == 'insert' else f't.`{field.name}`')} AS {kind_of})"
            for _, kind, values in clauses
        ]
        after.append(f"{case(given, f't.`{field.name}`')} AS `{field.name}`")
    flat = joined.selectExpr(
        f"{act} AS _act", "s._in_source AS _hit",
        f"struct({', '.join(f't.`{c}` AS `{c}`' for c in columns)}) AS _before",
        f"struct({', '.join(after)}) AS _after",
        *[f"t.`{key}` AS _key{i}" for i, key in enumerate(on)],
    )
    if not source_unique and matched:
        _refuse_double_changes(source, flat, on)
    return Merged(flat, columns)


def _values(given: Values | None, columns: Sequence[str]) -> Values:
    return {c: f"s.`{c}`" for c in columns} if given is None else given


def _refuse_double_changes(source: DataFrame, flat: DataFrame, on: Sequence[str]) -> None:
    repeated = source.groupBy(*on).count().where("count > 1")
    if repeated.isEmpty():
        return
    keys = [f"_key{i}" for i in range(len(on))]
    changed = flat.where(F.col("_act").isin("update", "delete"))
    # Target keys need not be unique: count source hits per distinct target row.
    hits = changed.groupBy(*keys, "_before").count().where("count > 1")
    clash = hits.join(repeated.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(on)]),
                      on=[F.col(f"_key{i}").eqNullSafe(F.col(f"_r{i}")) for i in range(len(on))],
                      how="left_semi")
    if not clash.isEmpty():
        raise MergeConflict(f"several source rows change one target row (keys: {', '.join(on)})")
