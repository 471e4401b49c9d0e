"""Quality reports and quarantined rows, as JSON."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.expectations import Suite, report
from tidemark.sources import files


#: Offsets of one quarantine folder: what a batch has to look through for rejects it may repeat.
OFFSETS = 1 << 20


def quarantine(rejected: DataFrame, root: str, stream: str, batch_id: int) -> bool:
    """Store a batch's rejected rows of one topic, each event once whatever comes twice.

        <root>/slice=S/stream=.../batch_id=B/    S: offsets by OFFSETS

    A replay rewrites its own folders. A new checkpoint is a new stream that counts its batches
    from 0 again and brings everything once more: rows whose partition and offset another
    batch has stored are left out, for which only the slices of this batch's offsets are read.
    Equal rows of different offsets are different events and all stay; rows without position
    can't be told apart and stay too. Gives whether there was any reject.
    """
    spark, mine = rejected.sparkSession, stream.rpartition(":")[2]
    position = ["kafka_partition", "kafka_offset"]
    slice_ = F.coalesce(F.call_function("div", F.col("kafka_offset"), F.lit(OFFSETS).cast("bigint")), F.lit(-1).cast("bigint"))
    placed = rejected.withColumns({"slice": slice_, "stream": F.lit(mine), "batch_id": F.lit(batch_id).cast("bigint")})
    slices = [r[0] for r in placed.select("slice").distinct().collect()]  # one number per million offsets of a batch
    if not slices:
        return False
    if files.list_names(spark, root):
        held = spark.read.schema("kafka_partition int, kafka_offset bigint, slice bigint, stream string, batch_id bigint").json(root)
        others = held.where(F.col("slice").isin(slices) & ~((F.col("stream") == mine) & (F.col("batch_id") == batch_id)))
        placed = placed.join(others.select(*position).distinct(), position, "left_anti").select(*placed.columns)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slice", "stream", "batch_id").json(root)
    return True


def write_report(suite: Suite, df: DataFrame, root: str, now: int | None = None) -> tuple[bool, str]:
    """Run a suite, write ``<root>/<suite>/<epoch seconds>/result.json``.

    Returns (success, folder). The report is one row, whatever the table's size.
    """
    outcome = report(suite, df).persist()
    try:
        folder = f"{root}/{suite.name}/{int(time.time()) if now is None else now}"
        outcome.coalesce(1).write.mode("overwrite").json(f"{folder}/result.json")
        return bool(outcome.first()["success"]), folder
    finally:
        outcome.unpersist()


def exit_code(success: bool) -> int:
    return 0 if success else 1
