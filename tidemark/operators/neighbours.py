"""Previous and next row of the same key, for keys of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = 1 << 20


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[Column],
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    slice_width: int | None = SLICE,
    among: Column | None = None,
    axis: Column | None = None,
    once: Sequence[Column] = (),
    best: Column | None = None,
) -> DataFrame:
    """Add columns of the previous / following row by ``order``, unique per key.

    ``previous`` and ``following`` map a new column name to a source column. With ``among``
    (over the columns of ``df`` and the previous ones) the following row is the next one that
    meets it, and ``_among`` says which rows do. Rows with a NULL key are left out.

    The integer ``axis`` (default: ``order``, an integer column then) is cut into slices of
    ``slice_width``, and a task holds a slice of a key at most, however large the key is. One
    shuffle by (key, slice) serves both readings of the rows: an aggregate sums a slice up
    (its first and last row, and its first row inside that meets ``among``), a window over
    those summaries tells each slice what lies before and after it, and the rows look across
    by one join on (key, slice). ``None`` is one plain window per key.

    With ``once`` the order need not be unique: of a key's rows equal in ``order`` and ``once``
    only the one with the greatest ``best`` is taken, in the sort that is there anyway.
    """
    previous, following = previous or {}, following or {}
    by = [F.col(order)] if isinstance(order, str) else list(order)
    back = F.struct(*[F.col(src).alias(name) for name, src in previous.items()]) if previous else F.lit(None)
    ahead = F.struct(*[F.col(src).alias(name) for name, src in following.items()]) if following else F.lit(None)
    meets = F.lit(True) if among is None else F.coalesce(among, F.lit(False))

    def flat(frame: DataFrame, struct: str, names: dict[str, str]) -> DataFrame:
        return frame.withColumns({name: F.col(f"{struct}.{name}") for name in names}) if names else frame

    def next_met(frame: DataFrame, value: str, window: str) -> Column:
        # The next row with a value; reads each row once, unlike a frame that looks ahead.
        return F.expr(f"lead(`{value}`) IGNORE NULLS OVER ({window})")

    def single(frame: DataFrame, *within: str) -> DataFrame:
        if not once:
            return frame
        # The windows below need a prefix of this order, so they don't sort again.
        frame = frame.withColumn("_same", F.struct("_rank", *once))
        sort = Window.partitionBy(*within).orderBy("_rank", "_same", *([best.desc()] if best is not None else []))
        repeated = F.lag("_same").over(sort).eqNullSafe(F.col("_same"))
        return frame.withColumn("_repeated", repeated).where("NOT _repeated").drop("_repeated", "_same")

    def finish(frame: DataFrame) -> DataFrame:
        shown = [F.col(c) for c in (*df.columns, *previous)] + [F.col(f"_next.{name}").alias(name) for name in following]
        return frame.select(*shown, *([F.col("_among")] if among is not None else []))

    quoted = ", ".join(f"`{k}`" for k in keys)
    if slice_width is None:
        # The rank follows from the row; after the shuffle, it does not travel.
        frame = single(df.repartition(*keys).withColumn("_rank", F.struct(*by)), *keys)
        frame = frame.withColumn("_prev", F.lag(back).over(Window.partitionBy(*keys).orderBy("_rank")))
        frame = flat(frame, "_prev", previous).withColumn("_among", meets)
        frame = frame.withColumn("_met", F.when(F.col("_among"), ahead))
        return finish(frame.withColumn("_next", next_met(frame, "_met", f"PARTITION BY {quoted} ORDER BY `_rank`")))

    position = F.col(order) if axis is None else axis
    nothing = F.lit(-1 << 62)
    slice_ = F.coalesce(F.call_function("div", position, F.lit(slice_width).cast("bigint")), nothing)
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    sliced = df.where(known).withColumn("_slice", slice_)
    inside = Window.partitionBy(*keys, "_slice").orderBy("_rank")
    # Both readings need the same rows and columns of it, or Spark would shuffle twice.
    frame = sliced.repartition(*keys, "_slice").withColumn("_rank", F.struct(*by))
    frame = single(frame, *keys, "_slice").withColumn("_prev", F.lag(back).over(inside))
    frame = frame.withColumn("_head", F.row_number().over(inside) == 1)
    frame = flat(frame, "_prev", previous).withColumn("_met", F.when(~F.col("_head") & meets, ahead))

    wanted = [c for c in df.columns if c != order]
    row = F.struct(*[F.col(c) for c in wanted])
    summary = frame.groupBy(*keys, "_slice").agg(
        F.min_by(row, "_rank").alias("_first"), F.max_by(back, "_rank").alias("_last"),
        F.min_by("_met", F.when(F.col("_met").isNotNull(), F.col("_rank"))).alias("_inner"),
    )
    slices = Window.partitionBy(*keys).orderBy("_slice")
    summary = summary.withColumn("_before", F.lag("_last").over(slices))
    first = summary.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_slice", "_before", "_inner", "_first")
    first = flat(first.select("*", *[F.col(f"_first.{c}").alias(c) for c in wanted]), "_before", previous)
    first = first.withColumn("_onset", F.coalesce(F.when(meets, ahead), F.col("_inner")))
    names = ", ".join(f"`_key{i}`" for i in range(len(keys)))
    first = first.withColumn("_after", next_met(first, "_onset", f"PARTITION BY {names} ORDER BY `_slice`"))
    first = first.select(*[F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)], "_slice", "_before", "_after")

    within = f"PARTITION BY {quoted}, `_slice` ORDER BY `_rank`"
    frame = frame.withColumn("_next_in", next_met(frame, "_met", within)).join(first, [*keys, "_slice"], "left")
    frame = frame.withColumn("_prev", F.when(F.col("_head"), F.col("_before")).otherwise(F.col("_prev")))
    frame = flat(frame, "_prev", previous).withColumn("_among", meets)
    return finish(frame.withColumn("_next", F.coalesce("_next_in", "_after")))
