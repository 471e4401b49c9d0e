"""A change log derived from the benchmark tables.

The log stands in for a broker: events drive the customers and orders topics, part
and lineitem the products and order_items topics. Everything is a plain DataFrame
over the whole input tables.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import CAPTURED, CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS, CdcTableSpec
from tidemark.sources.bronze import project_bronze

EVENTS_PER_BATCH = 1000
SPREAD = 32 << 20  # bytes of a table's files to a partition of JSON

OP = """CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS op"""
STATUS = """CASE event_type WHEN 'signup' THEN 'created' WHEN 'click' THEN 'approved'
    WHEN 'view' THEN 'shipped' WHEN 'purchase' THEN 'delivered' END AS order_status"""
STATE = """CASE WHEN k % 10 = 0 THEN 'XXX'
    ELSE element_at(array('SP', 'RJ', 'MG', 'PR', 'BA'), cast(1 + k % 5 AS int)) END AS customer_state"""


@lru_cache(maxsize=64)
def _parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return _parquet(spark, f"{sf_dir}/{name}.parquet")


def _spread(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table dealt out before its rows are turned into JSON: a file of one row group can't be
    split, and the narrow rows cost less than the JSON. Partitions grow in number with the files."""
    rows = table(spark, sf_dir, name)
    size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    many = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, -(-int(size) // SPREAD))
    return rows.repartition(many, key)


def batch_no() -> Column:
    """Micro-batch of an event, by its position in the log."""
    return F.expr(f"kafka_offset div {EVENTS_PER_BATCH}")


def _kafka_rows(df: DataFrame, topic: str, key: str, before: str, after: str) -> DataFrame:
    """Rows with op, ts, offset, partition to change events: flat envelopes at even
    offsets, wrapped in ``payload`` at odd ones. Images are lists of columns."""
    def image(columns: str) -> str:
        return f"struct({columns})"

    nulls = "map('ignoreNullFields', 'false')"
    envelope = df.selectExpr(
        f"to_json({image(key)}, {nulls}) AS k",
        f"""to_json(struct(op, unix_millis(ts) AS ts_ms,
            CASE WHEN op = 'd' THEN {image(before)} END AS before,
            CASE WHEN op <> 'd' THEN {image(after)} END AS after), {nulls}) AS flat""",
        "partition", "offset", "ts",
    )
    return envelope.selectExpr(
        "cast(k AS binary) AS key",
        """cast(if(offset % 2 = 0, flat, concat('{"payload":', flat, '}')) AS binary) AS value""",
        f"'{topic}' AS topic", "cast(partition AS int) AS partition",
        "cast(offset AS bigint) AS offset", "ts AS timestamp", "0 AS timestampType",
    )


def customers_topic(spark: SparkSession, sf_dir: str, prefix: str = "shop") -> DataFrame:
    rows = _spread(spark, sf_dir, "events", "event_id").selectExpr(
        "*", "cast(get_json_object(props, '$.k') AS bigint) AS k",
    ).selectExpr(
        OP, "cast(ts AS timestamp) AS ts", "event_id AS offset", "user_id % 4 AS partition",
        "CASE WHEN event_id % 97 <> 0 THEN concat('c_', user_id) END AS customer_id",
        "concat('u_', user_id) AS customer_unique_id", "concat('city_', k % 7) AS customer_city", STATE,
    )
    after = "customer_id, customer_unique_id, customer_city, customer_state"
    return _kafka_rows(rows, CUSTOMERS.topic(prefix), "customer_id", "customer_id", after)


def orders_topic(spark: SparkSession, sf_dir: str, prefix: str = "shop") -> DataFrame:
    rows = _spread(spark, sf_dir, "events", "event_id").selectExpr(
        OP, "cast(ts AS timestamp) AS ts", "event_id AS offset", "0 AS partition",
        "concat('o_', event_id % 2500) AS order_id",
        "CASE WHEN event_id % 89 <> 0 THEN concat('c_', user_id) END AS customer_id", STATUS,
    )
    after = "order_id, customer_id, order_status"
    return _kafka_rows(rows, ORDERS.topic(prefix), "order_id", "order_id, customer_id", after)


def products_topic(spark: SparkSession, sf_dir: str, prefix: str = "shop") -> DataFrame:
    rows = table(spark, sf_dir, "part").selectExpr(
        "'r' AS op", "timestamp_seconds(p_partkey) AS ts", "p_partkey AS offset", "p_partkey % 4 AS partition",
        "concat('p_', p_partkey) AS product_id", "p_type AS product_category", "p_size AS product_weight_g",
    )
    after = "product_id, product_category, product_weight_g"
    return _kafka_rows(rows, PRODUCTS.topic(prefix), "product_id", "product_id", after)


def order_items_topic(spark: SparkSession, sf_dir: str, prefix: str = "shop") -> DataFrame:
    rows = _spread(spark, sf_dir, "lineitem", "l_orderkey").selectExpr(
        "'c' AS op", "cast(l_shipdate AS timestamp) AS ts", "l_orderkey * 10 + l_linenumber AS offset",
        "l_orderkey % 4 AS partition", "concat('o_', l_orderkey) AS order_id", "l_linenumber AS order_item_id",
        "concat('p_', l_partkey) AS product_id",
        "cast(cast(l_extendedprice AS decimal(10,2)) AS string) AS price",
        "unix_micros(cast(l_shipdate AS timestamp)) AS shipping_limit_dt",
    )
    key = "order_id, order_item_id"
    after = f"{key}, product_id, price, shipping_limit_dt"
    return _kafka_rows(rows, ORDER_ITEMS.topic(prefix), key, key, after)


TOPICS = {
    CUSTOMERS: customers_topic, PRODUCTS: products_topic, ORDERS: orders_topic, ORDER_ITEMS: order_items_topic,
}


def kafka_log(
    spark: SparkSession, sf_dir: str, *specs: CdcTableSpec, prefix: str = "shop",
) -> DataFrame:
    """The topics of the named tables (default: all four), in the row shape of a Kafka reader."""
    logs = [TOPICS[spec](spark, sf_dir, prefix) for spec in specs or CAPTURED]
    return reduce(DataFrame.unionByName, logs)


def bronze(spark: SparkSession, sf_dir: str, *specs: CdcTableSpec, prefix: str = "shop") -> DataFrame:
    return project_bronze(kafka_log(spark, sf_dir, *specs, prefix=prefix))


def bulk_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table in the shape of the fact."""
    placed = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.unix_millis(placed).alias("event_ts_ms"),
        F.to_date("o_orderdate").alias("event_date"),
    )


def bulk_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation, in the shape of the dimension, all current."""
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
        F.lit(0).cast("bigint").alias("effective_start_ts_ms"),
        F.lit(None).cast("bigint").alias("effective_end_ts_ms"),
        F.lit(True).alias("is_current"),
    )
