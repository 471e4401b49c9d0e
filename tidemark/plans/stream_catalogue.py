"""Named queries that run the jobs as real streams over the whole change log.

The log is landed slice by slice, each slice a micro-batch, in a fresh folder of the
cluster's shared directory; the query returns what the job left there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changefeed import GROUP
from tidemark.operators.dedupe import latest_per_key
from tidemark.schemas import CUSTOMERS, ORDERS, REJECTED, CdcTableSpec
from tidemark.session import shared_dir
from tidemark.sources import files, replay
from tidemark.sources.bronze import LOG_CODEC, CdcSource
from tidemark.streaming.jobs import Lakehouse

SLICES = 4


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _lakehouse(spark: SparkSession) -> Lakehouse:
    return Lakehouse(spark, shared_dir(spark, "lakehouse"), buckets=4)


def _ingest(house: Lakehouse, log: DataFrame) -> None:
    """Land rows in the shape a Kafka reader delivers and take them into bronze."""
    landing = f"{house.root}/landing"
    log.write.mode("append").option("compression", LOG_CODEC).parquet(landing)
    _finish(house.start_bronze(CdcSource("files", path=landing), once=True))


def _slices(house: Lakehouse, sf_dir: str, spec: CdcTableSpec, backwards: bool = False) -> Iterator[int]:
    """Take the whole topic into bronze, in offset order or from its end, a slice at a time."""
    log = replay.kafka_log(house.spark, sf_dir, spec)
    last = replay.table(house.spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    width = last // SLICES + 1
    for n in reversed(range(SLICES)) if backwards else range(SLICES):
        _ingest(house, log.where(F.expr(f"offset div {width} = {n}")))
        yield n


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = _lakehouse(spark)
    _ingest(house, replay.kafka_log(spark, sf_dir))
    return house.bronze().select(
        "topic", "k", "v", F.unix_micros("kafka_ts").alias("kafka_ts_us"), "kafka_partition", "kafka_offset",
    )


def silver_customers_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = _lakehouse(spark)
    for _ in _slices(house, sf_dir, CUSTOMERS):
        _finish(house.start_silver(once=True))
    return house.silver.read()


def quarantine_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows read back, half of them seen by two checkpoints in turn: none is lost, none stored twice."""
    house = _lakehouse(spark)
    for n in _slices(house, sf_dir, CUSTOMERS):
        if n == SLICES // 2:
            files.delete(spark, f"{house.root}/checkpoints/silver_customers")
        _finish(house.start_silver(once=True))
    kept = spark.read.schema(REJECTED).json(f"{house.root}/quarantine/customers")
    return kept.select(*REJECTED.fieldNames())


def mart_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart as published and registered, read by its name."""
    house, name = _lakehouse(spark), f"mart_{uuid.uuid4().hex}"
    for spec, start in ((CUSTOMERS, house.start_dim), (ORDERS, house.start_fact)):
        for _ in _slices(house, sf_dir, spec):
            _finish(start(once=True))
    house.build_mart("mart_daily_orders", register_as=name)
    return spark.table(name)


def dim_customers_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = _lakehouse(spark)
    for _ in _slices(house, sf_dir, CUSTOMERS):
        _finish(house.start_dim(once=True))
    return house.dim.read()


def customer_history_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change by event time, the log landed from its end."""
    house = _lakehouse(spark)
    for _ in _slices(house, sf_dir, CUSTOMERS, backwards=True):
        _finish(house.start_history(once=True))
    return house.history.read()


def fact_orders_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = _lakehouse(spark)
    for _ in _slices(house, sf_dir, ORDERS):
        _finish(house.start_fact(once=True))
    return house.fact.read()


def agg_orders_daily_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = _lakehouse(spark)
    for _ in _slices(house, sf_dir, ORDERS):
        _finish(house.start_fact(once=True))
        _finish(house.start_agg(once=True))
    return house.agg.read().where("order_cnt <> 0")


def agg_orders_daily_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts started late, when all but the newest change rows of the fact are gone."""
    house = _lakehouse(spark)
    for n in _slices(house, sf_dir, ORDERS):
        _finish(house.start_fact(once=True))
        if n == SLICES // 2:
            for name in sorted(files.list_names(spark, house.fact.log.path))[:-1]:
                files.delete(spark, f"{house.fact.log.path}/{name}")
        if n >= SLICES // 2:
            _finish(house.start_agg(once=True, start="snapshot"))
    return house.agg.read().where("order_cnt <> 0")


def agg_orders_daily_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts out of Spark's state store: the last total each group was given."""
    house, totals = _lakehouse(spark), shared_dir(spark, "totals")

    def sink(changed: DataFrame, batch_id: int) -> None:
        stamped = changed.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        stamped.write.mode("overwrite").parquet(f"{totals}/{batch_id}")

    for n in _slices(house, sf_dir, ORDERS):
        _finish(house.start_fact(once=True))
        if n % 2:  # a trigger of its own need not follow every version
            _finish(house.start_agg_native(sink, once=True))
    given = spark.read.option("recursiveFileLookup", "true").parquet(totals)
    last = latest_per_key(given, GROUP, [F.col("batch_id")])
    return last.where("order_cnt <> 0").select(*GROUP, "order_cnt")


STREAM_QUERIES = {
    f.__name__: f for f in (
        bronze_ingest, silver_customers_stream, quarantine_stream, mart_by_name, dim_customers_stream, customer_history_stream, fact_orders_stream,
        agg_orders_daily_stream, agg_orders_daily_snapshot, agg_orders_daily_native,
    )
}
