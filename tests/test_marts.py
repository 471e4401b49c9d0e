"""Marts kept up by deltas, joins with heavy customers, suites in one scan."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemark.operators.changefeed import counts_after, deltas, merge_deltas
from tidemark.operators.dedupe import delete_wins_order, latest_per_key, latest_two
from tidemark.operators.expectations import agg_orders_daily_suite, compound_unique, fact_orders_suite, not_null, row_count_between, unique, unique_count_between, Suite
from tidemark.operators.reconcile import daily_counts, reconcile, reconcile_tree
from tidemark.operators.scd2 import compare_with_current, scd2_batch
from tidemark.plans import marts, tables
from tidemark.schemas import DIM_CUSTOMERS, FACT_ORDERS

ORDER_EVENT = "op string, ts_ms bigint, order_id string, customer_id string, order_status string, event_date date, kafka_partition int, kafka_offset bigint"
CUSTOMER_EVENT = "op string, ts_ms bigint, customer_id string, customer_unique_id string, customer_city string, customer_state string, kafka_partition int, kafka_offset bigint"


def kept(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


@pytest.mark.parametrize("seed", range(2))
def test_a_mart_kept_up_by_deltas_equals_its_rebuild(spark, seed):
    """Orders come, move and go; customers come, move, return and go; batch after batch."""
    import datetime

    rng, offset = random.Random(seed), 0
    fact, dim = spark.createDataFrame([], FACT_ORDERS), spark.createDataFrame([], DIM_CUSTOMERS)
    mart = marts.mart_daily_orders(fact, dim)
    for batch in range(3):
        orders, customers = [], []
        for _ in range(40):
            offset += 1
            day = datetime.date(2025, 1, rng.randrange(1, 4))
            orders.append((rng.choice("ccud"), offset, f"o{rng.randrange(30)}", rng.choice((None, *[f"c{i}" for i in range(8)])), rng.choice("xy"), day, 0, offset))
        for _ in range(6):
            offset += 1
            kind = rng.choice("cuud")
            customers.append((kind, offset, f"c{rng.randrange(8)}", "u", "z", None if kind == "d" else rng.choice(("SP", "RJ")), 0, offset))
        newest, moved = spark.createDataFrame(orders, ORDER_EVENT), spark.createDataFrame(customers, CUSTOMER_EVENT)
        merged = tables.fact_merge(fact, newest)
        compared = compare_with_current(dim, latest_per_key(moved, ["customer_id"], delete_wins_order()))
        change = marts.mart_deltas(merged.changes(), dim, merged.rows(), marts.customer_moves(compared))
        mart = kept(spark, marts.merge_mart(mart, change).rows())
        fact, dim = kept(spark, merged.rows()), kept(spark, scd2_batch(dim, moved))
        assert rows(mart) == rows(marts.mart_daily_orders(fact, dim))


def test_counts_off_one_join_equal_the_merged_deltas(spark):
    import datetime

    rng = random.Random(3)
    day = lambda: rng.choice((None, datetime.date(2025, 1, 1), datetime.date(2025, 1, 2)))
    data = [(rng.choice("cud"), n, f"o{rng.randrange(25)}", "c", rng.choice(("a", "b", None)), day(), 0, n) for n in range(120)]
    valid = spark.createDataFrame(data, ORDER_EVENT)
    before = kept(spark, tables.fact_state(valid.where("ts_ms < 60")))
    merged = tables.fact_merge(before, valid.where("ts_ms >= 60"))
    assert rows(counts_after(merged)) == rows(merge_deltas(daily_counts(before), deltas(merged.changes())).rows())


def test_two_states_off_one_aggregate(spark):
    data = [(n % 5, n, f"v{n}") for n in range(23)]
    df = spark.createDataFrame(data, "k int, n int, v string")
    both = latest_two(df, ["k"], [F.col("n")], F.col("n") < 3, ["n", "v"])
    assert rows(both, "k", "now.n", "before.n") == [(0, 20, 0), (1, 21, 1), (2, 22, 2), (3, 18, None), (4, 19, None)]


def test_a_heavy_customer_is_spread(spark):
    """One customer, and orders without customer, hold a third of all orders each; no help from AQE or broadcasts."""
    many = 30_000
    fact = spark.range(many).select(
        F.concat(F.lit("o"), "id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("c"), F.col("id") % 4000)).alias("customer_id"),
        F.lit("s").alias("order_status"), F.col("id").alias("event_ts_ms"), F.lit(None).cast("date").alias("event_date"),
    )
    dim = spark.range(4000).select(F.concat(F.lit("c"), "id").alias("customer_id"), F.lit("u").alias("customer_unique_id")).union(
        spark.createDataFrame([("hot", "u")], "customer_id string, u string"))
    dim = dim.select("*", F.concat(F.lit("city_"), "customer_id").alias("customer_city"), F.lit("SP").alias("customer_state"), F.lit(True).alias("is_current"))
    heavy = marts.heavy_customers(fact)
    assert [r["heavy_id"] for r in heavy.orderBy("heavy_id").collect()] == [None, "hot"]
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = marts.enrich_orders(fact, dim, heavy)
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 16 and sizes[-1] <= 3 * sizes[8]
        assert rows(joined) == rows(marts.enrich_orders(fact, dim))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_no_heavy_customers(spark):
    fact = spark.createDataFrame([], FACT_ORDERS)
    assert marts.heavy_customers(fact).count() == 0
    assert marts.enrich_orders(fact, spark.createDataFrame([], DIM_CUSTOMERS), marts.heavy_customers(fact)).count() == 0


def test_a_suite_scans_and_shuffles_once(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"), F.lit(1).cast("bigint").alias("event_ts_ms"), F.to_date("o_orderdate").alias("event_date"),
    )
    counts = daily_counts(orders)
    for suite, df, scans, keyed in ((fact_orders_suite(), orders, 1, 1), (agg_orders_daily_suite(), counts, 1, 2)):
        plan = suite.validate(df)._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[-1]
        assert plan.count("FileScan") == scans and plan.count("Exchange hashpartitioning") <= keyed


def test_several_keys_in_one_suite(spark):
    data = [("a", 1, None), ("a", 2, "x"), ("b", 1, "x"), (None, 1, "x"), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(data, "k string, n int, v string")
    suite = Suite("s", (unique("k"), compound_unique("k", "n"), unique_count_between("v", 1, 1), not_null("v"), row_count_between(6, 6), unique("absent"), unique("k")))
    got = rows(suite.validate(df), "position", "element_count", "missing_count", "unexpected_count", "observed_value", "success")
    assert got == [
        (1, 6, 3, 2, None, False), (2, 6, 2, 0, None, True), (3, 6, None, None, 1, True), (4, 6, 3, 3, None, False),
        (5, None, None, None, 6, True), (6, None, None, None, None, False), (7, 6, 3, 2, None, False),
    ]
    empty = rows(suite.validate(df.limit(0)), "position", "element_count", "success")
    assert empty == [(1, 0, True), (2, 0, True), (3, 0, False), (4, 0, True), (5, None, False), (6, None, False), (7, 0, True)]


def test_checksums_find_what_the_join_finds(spark):
    import datetime

    rng = random.Random(4)
    days = [None, *[datetime.date(2025, 1, d) for d in range(1, 25)]]
    fact = spark.createDataFrame([(f"o{i}", "c", rng.choice(("a", "b", None)), 1, rng.choice(days)) for i in range(500)], FACT_ORDERS)
    good = kept(spark, daily_counts(fact))
    assert reconcile_tree(fact, good).count() == 0 and reconcile_tree(fact, good.withColumn("order_cnt", F.col("order_cnt") * 1)).columns == reconcile(fact, good).columns
    for spoilt in (
        good.where("order_status IS NOT NULL"), good.withColumn("order_cnt", F.expr("CASE WHEN order_status = 'a' AND day(event_date) = 3 THEN 99 ELSE order_cnt END")),
        good.union(spark.createDataFrame([(None, "extra", 4)], good.schema)), good.limit(0), good.withColumn("order_cnt", F.expr("CASE WHEN order_status = 'b' THEN NULL ELSE order_cnt END")),
        # two groups swap a unit: the number of orders stays the same
        good.withColumn("order_cnt", F.expr("order_cnt + CASE WHEN order_status = 'a' AND day(event_date) = 5 THEN 1 WHEN order_status = 'b' AND day(event_date) = 5 THEN -1 ELSE 0 END")),
    ):
        for fan, levels in ((64, 2), (2, 3)):
            assert rows(reconcile_tree(fact, spoilt, fan, levels)) == rows(reconcile(fact, spoilt))
    assert rows(reconcile_tree(fact.limit(0), good)) == rows(reconcile(fact.limit(0), good))
