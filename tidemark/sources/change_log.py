"""Change rows of a table, a folder per write.

    <path>/commit=C~stream~batch/part-*.parquet

A folder is written before the table it belongs to and never again: a replayed micro-batch
finds its change rows there, so readers get each once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import files


@dataclass(frozen=True)
class ChangeLog:
    spark: SparkSession
    path: str
    row_schema: T.StructType

    @property
    def schema(self) -> T.StructType:
        return T.StructType(self.row_schema.fields + [T.StructField("_change_type", T.StringType()), T.StructField("_commit_version", T.LongType())])

    def _commits(self) -> dict[str, int]:
        """``stream~batch`` of every write, and its number."""
        names = [n.removeprefix("commit=").split("~", 1) for n in files.list_names(self.spark, self.path) if n.startswith("commit=")]
        return {who: int(number) for number, who in names}

    def last_commit(self) -> int:
        """The newest write's number, -1 before the first."""
        return max(self._commits().values(), default=-1)

    def append(self, changes: DataFrame, stream: str | None = None, batch_id: int = 0) -> int:
        """Add the change rows of one write, unless they are there, and give its number."""
        who = f"{uuid.uuid4().hex if stream is None else stream.rpartition(':')[2]}~{batch_id}"
        known = self._commits()
        commit = known.get(who, max(known.values(), default=-1) + 1)
        folder = f"{self.path}/commit={commit}~{who}"
        if not files.exists(self.spark, f"{folder}/_SUCCESS"):
            stamped = changes.withColumn("_commit_version", F.lit(commit).cast("bigint"))
            stamped.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(folder)
        return commit

    def read(self) -> DataFrame:
        if not files.list_names(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.fieldNames())

    def stream(self, **options: str) -> DataFrame:
        """Change rows as a stream, from the first on."""
        files.make_folder(self.spark, self.path)
        return self.spark.readStream.schema(self.schema).options(**options).parquet(self.path).select(*self.schema.fieldNames())
