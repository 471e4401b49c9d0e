"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm.cross_polytope import op4_cross_polytope
from tidemark.llm.itq import op3_itq_near_copies
from tidemark.llm.language import op7_language_fusion
from tidemark.llm.merkle import OP11_SQL, op11_merkle
from tidemark.llm.ngram_join import op9_ngram_join
from tidemark.llm.packing import op10_packing
from tidemark.llm.pieces import op2_pieces
from tidemark.llm.prefix_counts import op8_token_counts
from tidemark.llm.ranked_search import OP13_SQL, op13_search
from tidemark.llm.repeats import OP12_SQL, op12_repeats
from tidemark.llm.toxicity import op6_toxicity
from tidemark.llm.token_store import op1_token_store
from tidemark.llm.url_lists import OP5_SQL, op5_url_lists


def tokenizer_path(name: str) -> str:
    """Where the vocabulary files of the public tokenizers lie on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_token_store(spark, table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_pieces(spark, table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_itq_near_copies(spark, table(spark, sf_dir, "embeddings"))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_cross_polytope(spark, table(spark, sf_dir, "embeddings"))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_url_lists(spark, table(spark, sf_dir, "pages"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_language_fusion(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_token_counts(spark, table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_ngram_join(spark, table(spark, sf_dir, "documents"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_packing(spark, table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_merkle(spark, table(spark, sf_dir, "documents"))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_repeats(spark, table(spark, sf_dir, "documents"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_store": _op1,
    "op2_pieces": _op2,
    "op3_itq_near_copies": _op3,
    "op4_cross_polytope": _op4,
    "op5_url_lists": _op5,
    "op6_toxicity": _op6,
    "op7_language_fusion": _op7,
    "op8_token_counts": _op8,
    "op9_ngram_join": _op9,
    "op10_packing": _op10,
    "op11_merkle": _op11,
    "op12_repeats": _op12,
    "op13_search": _op13,
}

ORACLE: dict[str, str] = {"op5_url_lists": OP5_SQL, "op11_merkle": OP11_SQL, "op12_repeats": OP12_SQL, "op13_search": OP13_SQL}
