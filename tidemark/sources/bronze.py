"""The append-only log of raw change events."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import BRONZE, CAPTURED, KAFKA

#: Envelopes repeat their field names in every row: about half the bytes of the default codec.
LOG_CODEC = "zstd"


@dataclass(frozen=True)
class CdcSource:
    """Where change events arrive: Kafka topics, or files in the Kafka row shape.

    ``topics`` lists topics by name; without it every topic below the prefix is
    read. ``options`` go to the reader as they are (``maxOffsetsPerTrigger``,
    ``maxFilesPerTrigger``, security settings).
    """

    kind: str = "kafka"
    prefix: str = "shop"
    servers: str | None = None
    path: str | None = None
    topics: tuple[str, ...] | None = None
    file_format: str = "parquet"
    starting: str = "earliest"
    options: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def captured_topics(prefix: str = "shop") -> tuple[str, ...]:
        return tuple(spec.topic(prefix) for spec in CAPTURED)


def read_cdc_stream(spark: SparkSession, source: CdcSource) -> DataFrame:
    """A stream of Kafka-shaped rows: key, value, topic, partition, offset, timestamp."""
    if source.kind == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", source.servers)
            .option("startingOffsets", source.starting)
        )
        if source.topics:
            reader = reader.option("subscribe", ",".join(source.topics))
        else:
            reader = reader.option("subscribePattern", f"{source.prefix}.public.*")
        return reader.options(**source.options).load()
    if source.kind != "files":
        raise ValueError(f"unknown source kind {source.kind!r}")
    rows = (
        spark.readStream.schema(KAFKA).format(source.file_format)
        .options(**source.options).load(source.path)
    )
    if source.topics:
        return rows.where(F.col("topic").isin(*source.topics))
    return rows.where(F.col("topic").startswith(f"{source.prefix}.public."))


def project_bronze(kafka: DataFrame) -> DataFrame:
    """Kafka rows to bronze rows: bytes to text, columns named for the log."""
    return kafka.select(
        "topic",
        F.col("key").cast("string").alias("k"),
        F.col("value").cast("string").alias("v"),
        F.col("timestamp").alias("kafka_ts"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE).parquet(path).select(*BRONZE.fieldNames())


def read_bronze_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Bronze as a stream from its first file on; ``topic`` is a folder, so a topic
    filter reads that topic's files only."""
    rows = spark.readStream.schema(BRONZE).options(**options).parquet(path)
    return rows.select(*BRONZE.fieldNames())
