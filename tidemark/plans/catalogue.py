"""Named queries over a folder of benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rules import STATE_PATTERN, customer_rule, order_rule, split_valid
from tidemark.functions.scalars import event_date, try_bigint
from tidemark.operators.changefeed import counts_after, deltas, merge_deltas
from tidemark.operators.dedupe import delete_wins_order, latest_per_key, stream_order
from tidemark.operators.dml import insert_rows, update_where
from tidemark.operators.expectations import (
    agg_orders_daily_suite, fact_orders_suite, silver_customers_suite, statistics,
)
from tidemark.operators.neighbours import SLICE
from tidemark.operators.reconcile import daily_counts, reconcile, reconcile_tree
from tidemark.operators.scd2 import (
    OPENS, close_set, close_versions, compare_with_current, current_versions, history_merge,
    open_versions, scd2_batch, scd2_history,
)
from tidemark.plans import marts, tables
from tidemark.schemas import (
    AGG_ORDERS_DAILY, CAPTURED, CUSTOMERS, DIM_CUSTOMERS, FACT_STATE, HISTORY_STATE, ORDER_ITEMS, ORDERS, PRODUCTS, SILVER_STATE,
)
from tidemark.session import shared_dir
from tidemark.sources import replay

Query = Callable[[SparkSession, str], DataFrame]

CUSTOMER_COLUMNS = (
    "op", "ts_ms", "customer_id", "customer_unique_id", "customer_city", "customer_state",
    "kafka_partition", "kafka_offset",
)
ORDER_COLUMNS = ("op", "ts_ms", "order_id", "customer_id", "order_status", "event_date", "kafka_offset")


# --- inputs shared by the queries --------------------------------------------

def _customers(spark, sf_dir):
    return tables.customer_events(replay.bronze(spark, sf_dir, CUSTOMERS)).withColumn("batch_no", replay.batch_no())


def _orders(spark, sf_dir):
    return tables.order_events(replay.bronze(spark, sf_dir, ORDERS)).withColumn("batch_no", replay.batch_no())


def _valid_customers(spark, sf_dir):
    return split_valid(_customers(spark, sf_dir), customer_rule())[0]


def _valid_orders(spark, sf_dir):
    return split_valid(_orders(spark, sf_dir), order_rule())[0]


def _last_batch(spark, sf_dir):
    """The newest micro-batch, as a scalar subquery over the event ids."""
    events = replay.table(spark, sf_dir, "events").select(F.col("event_id").alias("kafka_offset"))
    return events.agg(F.max(replay.batch_no())).scalar()


def _around_last_batch(spark, sf_dir, valid):
    """(events of all earlier micro-batches, events of the newest one)."""
    last = _last_batch(spark, sf_dir)
    return valid.where(F.col("batch_no") < last), valid.where(F.col("batch_no") == last)


def _dim(spark, sf_dir):
    return scd2_history(_valid_customers(spark, sf_dir), "batch_no", slice_width=SLICE)


def _fact(spark, sf_dir):
    return tables.fact_state(_valid_orders(spark, sf_dir))


# --- log and parsing ----------------------------------------------------------

def cdc_events_by_topic(spark, sf_dir):
    log = replay.bronze(spark, sf_dir)
    parsed = [
        tables.topic_events(log, spec).select(F.lit(spec.topic()).alias("topic"), "op", "kafka_offset")
        for spec in CAPTURED
    ]
    return reduce(DataFrame.unionByName, parsed).groupBy("topic", "op").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("kafka_offset").alias("first_offset"), F.max("kafka_offset").alias("last_offset"),
    )


def bronze_projection(spark, sf_dir):
    return replay.bronze(spark, sf_dir).select(
        "topic", "k", "v", F.unix_micros("kafka_ts").alias("kafka_ts_us"),
        "kafka_partition", "kafka_offset",
    )


def parse_customers(spark, sf_dir):
    return _customers(spark, sf_dir).select(*CUSTOMER_COLUMNS)


def parse_orders(spark, sf_dir):
    return _orders(spark, sf_dir).select(*ORDER_COLUMNS)


def parse_products(spark, sf_dir):
    return tables.topic_events(replay.bronze(spark, sf_dir, PRODUCTS), PRODUCTS).select(
        "op", "ts_ms", *PRODUCTS.columns, "kafka_offset",
    )


def parse_order_items(spark, sf_dir):
    return tables.topic_events(replay.bronze(spark, sf_dir, ORDER_ITEMS), ORDER_ITEMS).select(
        "op", "ts_ms", "order_id", "order_item_id", "product_id", F.col("price").cast("double").alias("price"),
        F.to_date("shipping_limit_dt").alias("shipping_limit_date"), "kafka_offset",
    )


def valid_customers(spark, sf_dir):
    return _valid_customers(spark, sf_dir).select(*CUSTOMER_COLUMNS)


def valid_orders(spark, sf_dir):
    return _valid_orders(spark, sf_dir).select(*ORDER_COLUMNS)


def quarantine_customers(spark, sf_dir):
    return split_valid(_customers(spark, sf_dir), customer_rule())[1].select(*CUSTOMER_COLUMNS)


def quarantine_dim(spark, sf_dir):
    rejected = split_valid(tables.keyed(_customers(spark, sf_dir)), customer_rule())[1]
    return rejected.select(*CUSTOMER_COLUMNS)


def quarantine_orders(spark, sf_dir):
    return split_valid(_orders(spark, sf_dir), order_rule())[1].select(*ORDER_COLUMNS)


# --- latest per key -----------------------------------------------------------

def dedupe_stream_order(spark, sf_dir):
    valid = _valid_customers(spark, sf_dir).select(*CUSTOMER_COLUMNS)
    return latest_per_key(valid, ["customer_id"], stream_order())


def dedupe_delete_wins(spark, sf_dir):
    valid = _valid_customers(spark, sf_dir).select(*CUSTOMER_COLUMNS)
    return latest_per_key(valid, ["customer_id"], delete_wins_order(), method="row_number")


def dedupe_orders(spark, sf_dir):
    valid = _valid_orders(spark, sf_dir).select(*ORDER_COLUMNS, "kafka_partition")
    return latest_per_key(valid, ["order_id"], delete_wins_order()).select(*ORDER_COLUMNS)


# --- current-state tables -----------------------------------------------------

def silver_customers(spark, sf_dir):
    return tables.silver_state(_valid_customers(spark, sf_dir))


def silver_customers_merge(spark, sf_dir):
    earlier, newest = _around_last_batch(spark, sf_dir, _valid_customers(spark, sf_dir))
    return tables.silver_merge(tables.silver_state(earlier), newest).rows()


def silver_customers_guarded(spark, sf_dir):
    """The newest micro-batch is merged first and all earlier events arrive late."""
    earlier, newest = _around_last_batch(spark, sf_dir, _valid_customers(spark, sf_dir))
    return tables.silver_merge(tables.silver_state(newest), earlier, guard="event_time").rows()


def silver_customers_late(spark, sf_dir):
    """Micro-batches in reverse: the newest events come first, with their deletes, all others late."""
    earlier, newest = _around_last_batch(spark, sf_dir, _valid_customers(spark, sf_dir))
    empty = spark.createDataFrame([], SILVER_STATE)
    state = tables.silver_merge_ordered(empty, newest).rows()
    return tables.silver_merge_ordered(state, earlier).rows().where(tables.LIVE).drop(*tables.HIDDEN)


def fact_orders_late(spark, sf_dir):
    """The same for orders."""
    earlier, newest = _around_last_batch(spark, sf_dir, _valid_orders(spark, sf_dir))
    empty = spark.createDataFrame([], FACT_STATE)
    state = tables.fact_merge_ordered(empty, newest).rows()
    return tables.fact_merge_ordered(state, earlier).rows().where(tables.LIVE).drop(*tables.HIDDEN)


def fact_orders(spark, sf_dir):
    return _fact(spark, sf_dir)


def fact_orders_merge(spark, sf_dir):
    earlier, newest = _around_last_batch(spark, sf_dir, _valid_orders(spark, sf_dir))
    return tables.fact_merge(tables.fact_state(earlier), newest).rows()


# --- type-2 dimension ----------------------------------------------------------

def _stored(spark, df):
    """The rows as a written table: a merge reads its target several times."""
    path = shared_dir(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _dim_and_newest(spark, sf_dir):
    """(the dimension before the newest micro-batch, that batch)."""
    earlier, newest = _around_last_batch(spark, sf_dir, tables.keyed(_valid_customers(spark, sf_dir)))
    dim = scd2_history(earlier, "batch_no", slice_width=SLICE)
    return _stored(spark, dim), newest


def _scd2_compared(spark, sf_dir):
    dim, newest = _dim_and_newest(spark, sf_dir)
    batch = latest_per_key(newest, ["customer_id"], delete_wins_order())
    return dim, compare_with_current(dim, batch)


def scd2_changes(spark, sf_dir):
    return _scd2_compared(spark, sf_dir)[1].select(
        "op", "ts_ms", "customer_id", "has_current", "differs",
    )


def scd2_close(spark, sf_dir):
    dim, compared = _scd2_compared(spark, sf_dir)
    return close_versions(dim, close_set(compared))


def scd2_open(spark, sf_dir):
    dim, compared = _scd2_compared(spark, sf_dir)
    return open_versions(dim, compared)


def dim_customers_scd2(spark, sf_dir):
    return _dim(spark, sf_dir)


def dim_customers_scd2_merge(spark, sf_dir):
    return scd2_batch(*_dim_and_newest(spark, sf_dir))


def dim_customers_every_change(spark, sf_dir):
    return scd2_history(_valid_customers(spark, sf_dir), "batch_no", collapse="none", slice_width=SLICE)


def dim_customers_late(spark, sf_dir):
    """Every change, with micro-batches in reverse: the newest first, then the later and the earlier half of all others."""
    valid, last = _valid_customers(spark, sf_dir), _last_batch(spark, sf_dir)
    half = F.expr("batch_no * 2") >= last
    state = spark.createDataFrame([], HISTORY_STATE)
    for part in (F.col("batch_no") == last, (F.col("batch_no") < last) & half, (F.col("batch_no") < last) & ~half):
        state = _stored(spark, history_merge(state, valid.where(part)))
    return state.where(OPENS).select(*DIM_CUSTOMERS.fieldNames())


def dim_current(spark, sf_dir):
    return current_versions(_dim(spark, sf_dir))


# --- change feed and kept counts ------------------------------------------------

def change_feed(spark, sf_dir):
    return tables.fact_changes(_valid_orders(spark, sf_dir), "batch_no", SLICE)


def change_feed_merge(spark, sf_dir):
    earlier, newest = _around_last_batch(spark, sf_dir, _valid_orders(spark, sf_dir))
    return tables.fact_merge(tables.fact_state(earlier), newest).changes()


def change_deltas(spark, sf_dir):
    return deltas(change_feed(spark, sf_dir), drop_zero="before")


def agg_orders_daily(spark, sf_dir):
    """Counts from the change feed alone, from its first version on."""
    empty = spark.createDataFrame([], AGG_ORDERS_DAILY)
    return merge_deltas(empty, deltas(change_feed(spark, sf_dir))).rows()


def agg_orders_daily_next(spark, sf_dir):
    """Counts seeded before the newest micro-batch, then kept up from its changes."""
    earlier, newest = _around_last_batch(spark, sf_dir, _valid_orders(spark, sf_dir))
    return counts_after(tables.fact_merge(tables.fact_state(earlier), newest))


def agg_orders_daily_seed(spark, sf_dir):
    return daily_counts(_fact(spark, sf_dir))


def fact_daily_counts(spark, sf_dir):
    return daily_counts(replay.bulk_fact(spark, sf_dir))


def reconcile_counts(spark, sf_dir):
    """Checked against counts spoilt on purpose: one status gone, one a unit too high."""
    fact = replay.bulk_fact(spark, sf_dir)
    return reconcile(fact, _spoilt_counts(fact))


def _spoilt_counts(fact):
    return daily_counts(fact).where("order_status <> 'F'").withColumn(
        "order_cnt", F.expr("order_cnt + CASE WHEN order_status = 'P' THEN 1 ELSE 0 END"),
    )


def reconcile_by_tree(spark, sf_dir):
    """The same differences, found by checksums of ranges of groups."""
    fact = replay.bulk_fact(spark, sf_dir)
    return reconcile_tree(fact, _spoilt_counts(fact))


def reconcile_cdc(spark, sf_dir):
    """The fact against counts kept from the change feed of all but the newest batch."""
    stale = change_feed(spark, sf_dir).where(F.col("_commit_version") < _last_batch(spark, sf_dir))
    counts = deltas(stale).withColumnRenamed("delta_cnt", "order_cnt")
    return reconcile(_fact(spark, sf_dir), counts)


# --- marts ----------------------------------------------------------------------

def mart_daily_orders(spark, sf_dir):
    return marts.mart_daily_orders(_fact(spark, sf_dir), _dim(spark, sf_dir))


def mart_orders_by_state(spark, sf_dir):
    return marts.mart_orders_by_state(_fact(spark, sf_dir), _dim(spark, sf_dir))


def mart_daily_orders_next(spark, sf_dir):
    """The mart of before the newest micro-batch, kept up from that batch of orders and customers."""
    dim, customers = _dim_and_newest(spark, sf_dir)
    earlier, newest = _around_last_batch(spark, sf_dir, _valid_orders(spark, sf_dir))
    fact = _stored(spark, tables.fact_state(earlier))
    merged = tables.fact_merge(fact, newest)
    moves = marts.customer_moves(compare_with_current(dim, latest_per_key(customers, ["customer_id"], delete_wins_order())))
    deltas_ = marts.mart_deltas(merged.changes(), dim, merged.rows(), moves)
    return marts.merge_mart(marts.mart_daily_orders(fact, dim), deltas_).rows()


def orders_enriched(spark, sf_dir):
    """Orders of before the newest micro-batch, then upserted with the fact of now.

    Whole rows by key: what is there now replaces what was, and what is gone stays. Both states
    come off one aggregate and get their places by one join.
    """
    states = tables.fact_states(_valid_orders(spark, sf_dir), F.col("batch_no") < _last_batch(spark, sf_dir))
    upserted = states.select(F.coalesce("now", "before").alias("row")).where("row IS NOT NULL").select("row.*")
    return marts.enrich_orders(upserted, _dim(spark, sf_dir))


def mart_daily_orders_bulk(spark, sf_dir):
    return marts.mart_daily_orders(replay.bulk_fact(spark, sf_dir), replay.bulk_dim(spark, sf_dir))


def mart_orders_by_state_bulk(spark, sf_dir):
    return marts.mart_orders_by_state(replay.bulk_fact(spark, sf_dir), replay.bulk_dim(spark, sf_dir))


def orders_enriched_bulk(spark, sf_dir):
    fact = replay.bulk_fact(spark, sf_dir)
    return marts.enrich_orders(fact, replay.bulk_dim(spark, sf_dir), marts.heavy_customers(fact))


# --- row changes and counts -------------------------------------------------------

def dml_insert(spark, sf_dir):
    """One extra order per customer, placed beside the existing ones; nothing is deduped."""
    fact = replay.bulk_fact(spark, sf_dir)
    placed = F.lit(1_756_860_199_471).cast("bigint")
    rows = replay.bulk_dim(spark, sf_dir).select(
        F.concat(F.lit("new_"), "customer_id").alias("order_id"), "customer_id",
        F.lit("created").alias("order_status"), placed.alias("event_ts_ms"),
        event_date(placed).alias("event_date"),
    )
    return insert_rows(fact, rows)


def dml_update(spark, sf_dir):
    return update_where(
        replay.bulk_fact(spark, sf_dir), "order_status = 'P' OR event_date < DATE '1995-01-01'",
        {"order_status": "concat('was_', order_status)", "event_ts_ms": "event_ts_ms + 1"},
    )


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def table_row_counts(spark, sf_dir):
    counts = [
        replay.table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


# --- quality suites ----------------------------------------------------------------

def suite_silver_customers(spark, sf_dir):
    return silver_customers_suite().validate(silver_customers(spark, sf_dir))


def suite_fact_orders(spark, sf_dir):
    return fact_orders_suite().validate(_fact(spark, sf_dir))


def suite_agg_orders_daily(spark, sf_dir):
    return agg_orders_daily_suite().validate(agg_orders_daily(spark, sf_dir))


def suite_bulk_orders(spark, sf_dir):
    """The fact suite on plain orders, whose statuses are not in the set: it fails."""
    return fact_orders_suite().validate(replay.bulk_fact(spark, sf_dir))


def suite_unexpected_values(spark, sf_dir):
    """The customer suite on unvalidated events: bad states and repeated keys show."""
    return silver_customers_suite().unexpected_values(_customers(spark, sf_dir)).select(
        "expectation", "column", "value", "count",
    )


def suite_statistics(spark, sf_dir):
    results = [
        suite_silver_customers(spark, sf_dir), suite_agg_orders_daily(spark, sf_dir),
        suite_bulk_orders(spark, sf_dir),
    ]
    return statistics(reduce(DataFrame.unionByName, results))


# --- scalar expressions ---------------------------------------------------------------

def scalar_json(spark, sf_dir):
    return replay.table(spark, sf_dir, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k_text"),
        F.get_json_object("props", "$.absent").alias("absent"),
        F.coalesce(F.get_json_object("props", "$.absent.k"), F.get_json_object("props", "$.k"))
        .alias("first_found"),
        F.get_json_object("event_type", "$.k").alias("malformed"),
    )


def scalar_cast(spark, sf_dir):
    value = F.col("value")
    return replay.table(spark, sf_dir, "events").select(
        "event_id",
        try_bigint(value.cast("string")).alias("whole"),
        try_bigint(F.col("event_type")).alias("junk"),
        (try_bigint(F.get_json_object("props", "$.k")) * 2 + 1).alias("odd"),
        F.col("user_id").cast("string").alias("user_text"),
        F.col("user_id").cast("int").alias("user_int"),
        (F.col("event_id") / F.lit(4)).alias("quarter"),
    )


def scalar_predicates(spark, sf_dir):
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("bigint")
    state = F.when(k % 3 != 0, F.upper(F.substring("event_type", 1, 2)))
    rows = replay.table(spark, sf_dir, "events").select(
        "event_id", kind.alias("kind"), k.alias("k"), state.alias("state"),
    )
    matches = F.col("state").rlike(STATE_PATTERN)
    return rows.select(
        "event_id", matches.alias("matches"),
        F.col("kind").isin("click", "view").alias("in_list"),
        (matches & (F.col("k") > 50)).alias("and_null"),
        (matches | (F.col("k") > 50)).alias("or_null"),
        (F.col("state") != F.lit("CL")).alias("not_equal"),
        F.col("state").isNull().alias("missing"),
        F.when(F.col("k") < 10, "low").when(F.col("k") < 50, "mid").otherwise(F.lit(None).cast("string"))
        .alias("bucket"),
        F.coalesce("state", F.lit("")).alias("state_or_blank"),
    )


def scalar_event_date(spark, sf_dir):
    ts_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return replay.table(spark, sf_dir, "events").select(
        "event_id", event_date(ts_ms).alias("utc_date"),
        event_date(ts_ms, "America/Bogota").alias("bogota_date"),
        event_date(ts_ms, "Asia/Tokyo").alias("tokyo_date"),
    )


BATCH_QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        cdc_events_by_topic, bronze_projection, parse_customers, parse_orders, parse_products,
        parse_order_items, valid_customers, valid_orders, quarantine_customers, quarantine_dim,
        quarantine_orders, dedupe_stream_order, dedupe_delete_wins, dedupe_orders, silver_customers,
        silver_customers_merge, silver_customers_guarded, silver_customers_late, fact_orders, fact_orders_late, fact_orders_merge, scd2_changes,
        scd2_close, scd2_open, dim_customers_scd2, dim_customers_scd2_merge, dim_customers_every_change,
        dim_customers_late, dim_current, change_feed, change_feed_merge, change_deltas, agg_orders_daily,
        agg_orders_daily_next, agg_orders_daily_seed, fact_daily_counts, reconcile_cdc,
        mart_daily_orders, mart_daily_orders_next, mart_orders_by_state, orders_enriched, mart_daily_orders_bulk,
        mart_orders_by_state_bulk, orders_enriched_bulk, dml_insert, dml_update, table_row_counts,
        suite_silver_customers, suite_fact_orders, suite_agg_orders_daily, suite_bulk_orders,
        suite_unexpected_values, suite_statistics, scalar_json, scalar_cast, scalar_predicates,
        scalar_event_date,
    )
}
BATCH_QUERIES["reconcile"] = reconcile_counts
BATCH_QUERIES["reconcile_tree"] = reconcile_by_tree
