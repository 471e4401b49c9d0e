"""Documents to training sequences: toxicity, language, near copies, packing.

Every stage takes what its predecessor kept, written as Parquet and read again, so a lost
executor costs a stage at most. All but the last hand on the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import set_aside, stored, table
from tidemark.llm.language import fit_trigrams, keep_identified
from tidemark.llm.ngram_join import ngram_components
from tidemark.llm.packing import op10_packing
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.toxicity import fit, keep_clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the network, trained on ``labels``, scores 0.5 or more."""
    return keep_clean(docs, fit(docs, table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in none of the languages: without letters, unlike all texts of the language
    that text, declared language and source speak for, or with less than even odds for it."""
    return keep_identified(docs, fit_trigrams(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group.

    Rows that share a doc_id are one document, and the row with the smallest text stays.
    Rows without doc_id can't be told apart from others and stay.
    """
    first = ngram_components(docs).where("doc_id = component_id").select("doc_id").distinct()
    order = Window.partitionBy("doc_id").orderBy("text")
    rows, given = set_aside(docs, ["doc_id", "text"])
    kept = rows.join(first, "doc_id", "left_semi").withColumn("copy", F.row_number().over(order)).where("copy = 1")
    return kept.select(*given).union(docs.where("doc_id is null"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its place in a sequence of at most 1024 tokens."""
    return op10_packing(spark, docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("language", language), ("ngram_jaccard", near_copies), ("packing", packing)]

#: A trained network decides, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
