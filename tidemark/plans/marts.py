"""Reporting marts over the order fact and the current customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import change_sign, is_upsert
from tidemark.operators.merge import Delete, Insert, Merged, Update, apply_merge
from tidemark.operators.scd2 import current_versions


def _counts_by_state(fact: DataFrame, dim: DataFrame, by: tuple[str, ...], name: str) -> DataFrame:
    """Count orders per (``by``, customer state); orders without customer keep a NULL state.

    Orders are counted per customer before the join: a customer with a third of
    all orders shrinks to one row per (``by``) on the map side and cannot overload
    the join. No side is hinted: Spark broadcasts the dimension only when its size
    allows.
    """
    per_customer = fact.groupBy("customer_id", *by).agg(F.count(F.lit(1)).alias("_n"))
    states = current_versions(dim).select("customer_id", "customer_state")
    return (
        per_customer.join(states, "customer_id", "left")
        .groupBy("event_date", "customer_state", *[c for c in by if c != "event_date"])
        .agg(F.sum("_n").alias(name))
    )


def mart_daily_orders(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return _counts_by_state(fact, dim, ("event_date", "order_status"), "order_count")


def mart_orders_by_state(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return _counts_by_state(fact, dim, ("event_date",), "orders_cnt")


def customer_moves(compared: DataFrame) -> DataFrame:
    """(customer_id, old_state, new_state) of the customers a batch moves, from ``compare_with_current``."""
    lives, had = is_upsert(F.col("op")), F.col("has_current")
    old = F.when(had, F.col("t_customer_state"))
    # A version stays open when nothing differs, and keeps its state.
    new = F.when(lives, F.when(had & ~F.col("differs"), F.col("t_customer_state")).otherwise(F.col("customer_state")))
    return compared.select("customer_id", old.alias("old_state"), new.alias("new_state")).where("NOT (old_state <=> new_state)")


def mart_deltas(changes: DataFrame, dim_before: DataFrame, fact_after: DataFrame, moves: DataFrame) -> DataFrame:
    """What a batch adds to ``mart_daily_orders``: change of the fact with the old dimension, and
    change of the dimension with the new fact, retractions included.

    Reads the states of customers with changed orders, and the orders of customers that moved.
    """
    by = ("event_date", "order_status")
    signed = changes.groupBy("customer_id", *by).agg(F.sum(change_sign(F.col("_change_type"))).alias("_n")).where("_n <> 0")
    asked = signed.select("customer_id").distinct()
    states = current_versions(dim_before).select("customer_id", "customer_state").join(asked, "customer_id", "left_semi")
    first = signed.join(states, "customer_id", "left").select(*by, "customer_state", "_n")
    moved = fact_after.join(moves, "customer_id").groupBy(*by, "old_state", "new_state").agg(F.count(F.lit(1)).alias("_n"))
    turn = lambda state, n: F.struct(*by, F.col(state).alias("customer_state"), n.alias("_n"))
    second = moved.select(F.inline(F.array(turn("old_state", -F.col("_n")), turn("new_state", F.col("_n")))))
    summed = first.unionByName(second).groupBy("event_date", "customer_state", "order_status").agg(F.sum("_n").alias("delta_cnt"))
    return summed.where("delta_cnt <> 0")


def merge_mart(mart: DataFrame, deltas: DataFrame) -> Merged:
    """The mart with its deltas added; groups without orders leave it, as in a rebuild."""
    group = ("event_date", "customer_state", "order_status")
    return apply_merge(
        mart, deltas, group, null_safe=True, source_unique=True,
        matched=[Delete(when="t.order_count + s.delta_cnt = 0"), Update({"order_count": "t.order_count + s.delta_cnt"})],
        not_matched=[Insert({**{g: f"s.{g}" for g in group}, "order_count": "s.delta_cnt"})],
    )


#: Customers a summary of frequent items may name, and how many it follows to find them.
HEAVY, FOLLOWED = 512, 8192


def heavy_customers(fact: DataFrame) -> DataFrame:
    """(customer_id, salts) of customers with more than a share of 1 in HEAVY of all orders, HEAVY rows at most.

    A mergeable summary of frequent items, so one pass over one column with one small row per task.
    ``customer_id`` is NULL for orders without customer, which are salted likewise.
    """
    spark = fact.sparkSession
    row = fact.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("customer_id").isNull()).alias("none"),
        F.expr(f"approx_top_k(customer_id, {HEAVY}, {FOLLOWED})").alias("top"),
    ).first()
    share = max(1, -(-row["n"] // HEAVY))
    named = [(r["item"], r["count"]) for r in row["top"] or () if r["item"] is not None] + [(None, row["none"])]
    heavy = [(item, -(-n // share)) for item, n in named if n > share]
    return spark.createDataFrame(heavy, "heavy_id string, salts bigint")


def enrich_orders(fact: DataFrame, dim: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Each order with its customer's current city and state (NULL if none).

    With ``heavy`` (from ``heavy_customers``) the orders of a frequent customer are dealt over
    salts by their key and only that customer's row is repeated, once per salt: no task gets more
    than a share of them. Without it a hot customer is left to AQE's skew join.
    """
    places = current_versions(dim).select("customer_id", "customer_city", "customer_state")
    columns = ("order_id", "customer_id", "order_status", "event_ts_ms", "event_date", "customer_city", "customer_state")
    if heavy is None:
        return fact.join(places, "customer_id", "left").select(*columns)
    heavy = F.broadcast(heavy)  # HEAVY rows at most
    mine = F.col("customer_id").eqNullSafe(F.col("heavy_id"))
    many = F.coalesce("salts", F.lit(1).cast("bigint"))
    dealt = fact.join(heavy, mine, "left").withColumn("_salt", F.pmod(F.xxhash64("order_id"), many)).drop("heavy_id", "salts")
    repeated = places.join(heavy, mine, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), many - 1)))
    return dealt.join(repeated.drop("heavy_id", "salts"), ["customer_id", "_salt"], "left").select(*columns)


def orders_enriched_merge(target: DataFrame, enriched: DataFrame, source_unique: bool = False) -> Merged:
    """Upsert whole rows by order. Orders that left the fact stay in the target.

    Two current versions of one customer fan an order out; such a clash raises,
    unless ``source_unique`` vouches for one row per order and saves the check.
    """
    return apply_merge(
        target, enriched, ["order_id"], matched=[Update()], not_matched=[Insert()],
        source_unique=source_unique,
    )
