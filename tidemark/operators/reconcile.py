"""Independent recount of the fact against the kept daily counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_counts(fact: DataFrame, name: str = "order_cnt") -> DataFrame:
    return fact.groupBy("event_date", "order_status").agg(F.count(F.lit(1)).alias(name))


def reconcile(fact: DataFrame, counts: DataFrame) -> DataFrame:
    """Groups whose recount and kept count differ; a missing group counts as 0.

    NULL groups match each other. Empty means consistent. Sorted for reading.
    """
    recount = daily_counts(fact, "cnt_fact").alias("f")
    kept = counts.select("event_date", "order_status", F.col("order_cnt").alias("cnt_agg")).alias("a")
    same_group = F.lit(True)
    for column in ("event_date", "order_status"):
        same_group = same_group & F.col(f"f.{column}").eqNullSafe(F.col(f"a.{column}"))
    both = recount.join(kept, same_group, "full_outer").select(
        F.coalesce("f.event_date", "a.event_date").alias("event_date"),
        F.coalesce("f.order_status", "a.order_status").alias("order_status"),
        "cnt_fact", "cnt_agg",
    )
    zero = F.lit(0)
    differs = F.coalesce("cnt_fact", zero) != F.coalesce("cnt_agg", zero)
    return both.where(differs).orderBy("event_date", "order_status")


def reconcile_tree(fact: DataFrame, counts: DataFrame, fan: int = 64, levels: int = 2) -> DataFrame:
    """The rows of ``reconcile``, found by checksums: for consistent tables no group is shuffled.

    Groups are dealt into ``fan`` ranges by a hash, ranges into ``fan`` ranges again. The sum
    over all orders of their group's hashes is the sum over all groups of count times hashes, so
    both sides are summed per range straight from their rows. Only ranges whose sums differ are
    looked into further, and only groups of the last such ranges are counted and joined.
    """
    group = [F.col("event_date"), F.col("order_status")]
    prints = [F.xxhash64(F.lit(seed), *group).cast("decimal(38,0)") for seed in (1, 2)]
    cnt = F.coalesce("order_cnt", F.lit(0)).cast("decimal(18,0)")
    for level in range(1, levels + 1):
        many = fan**level
        part = F.pmod(F.xxhash64(*group), F.lit(many)).alias("part")
        ours = fact.groupBy(part).agg(F.count(F.lit(1)).cast("decimal(38,0)").alias("n"), *[F.sum(h).alias(f"s{i}") for i, h in enumerate(prints)])
        kept = counts.groupBy(part).agg(F.sum(cnt).alias("n"), *[F.sum((cnt * h.cast("decimal(20,0)")).cast("decimal(38,0)")).alias(f"s{i}") for i, h in enumerate(prints)])
        both = ours.alias("f").join(kept.alias("k"), "part", "full_outer")
        zero = F.lit(0).cast("decimal(38,0)")
        same = [F.coalesce(f"f.{c}", zero) == F.coalesce(f"k.{c}", zero) for c in ("n", "s0", "s1")]
        # At most fan ** levels small numbers.
        differ = [r["part"] for r in both.where(~(same[0] & same[1] & same[2])).select("part").collect()]
        if not differ:
            return reconcile(fact.limit(0), counts.limit(0))
        fact, counts = fact.where(part.isin(differ)), counts.where(part.isin(differ))
    return reconcile(fact, counts)
