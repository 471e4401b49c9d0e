import datetime as dt
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_cases import SCHEMA, documents, prose

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import language, url_lists
from tidemark.llm.queries import QUERIES


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_address_lists_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    want = con.execute(f"SELECT page_id, host, fetched_at, active_entries, blocked FROM ({entry.oracle_sql()['op5_url_lists']}) ORDER BY ALL").fetchall()
    got = entry.queries()["op5_url_lists"](spark, sf_dir).select("page_id", "host", "fetched_at", "active_entries", "blocked")
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean texts, toxic texts with labels, near copies, and texts that no language claims."""
    root = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, prose(i, 80), "en") for i in range(160)]
    rows = [(i, t + " vilgrunt and sclorp" if i % 4 == 0 else t, k) for i, t, k in rows]
    near = [(1000 + i, rows[i][1] + " tail", "en") for i in (1, 2, 3)] + [(2001, rows[5][1], "en")]
    junk = [(3000, None, "en"), (3001, "", "en"), (3002, "123 456 !!", None)]
    docs = documents(spark, rows + near + junk + [(6, rows[6][1], "en"), (None, prose(77777, 60), "en")])
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 160)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_stages_take_effect_and_keep_the_columns(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, corpus).write.parquet(f"{corpus}/{name}")
        docs = spark.read.parquet(f"{corpus}/{name}")
        assert docs.columns == columns
        left[name] = sorted((r["doc_id"] for r in docs.select("doc_id").collect()), key=lambda i: (i is None, i))
    clean = [i for i in range(160) if i % 4]
    assert [i for i in left["toxicity"] if i is not None and i < 160 and i % 4 == 0] == [] and set(clean) <= set(left["toxicity"])
    assert not {3000, 3001, 3002} & set(left["language"]) and set(clean) <= set(left["language"])
    assert left["ngram_jaccard"] == [*clean, None]


LETTERS = {"en": "thewandrgis", "de": "chunderigtsz", "fr": "leauxqitnrpo", "left out": "kovamyjzspd"}


def tongue(name, seed, words=120):
    """Words of two to four syllables over the letters of a made-up language."""
    rng, own = random.Random(f"{name} {seed}"), random.Random(name)
    syllables = ["".join(own.choice(LETTERS[name]) for _ in range(3)) for _ in range(40)]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(words))


def gibberish(seed, words=120):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(words))


def test_language_stage_rejects_gibberish_and_languages_it_does_not_know(spark, sf_dir):
    good = [(i, tongue(k, i), k if i % 5 else None) for k, at in (("en", 0), ("de", 100), ("fr", 200)) for i in range(at, at + 60)]
    odd = [(500 + i, gibberish(i), "en" if i % 2 else None) for i in range(20)] + [(600 + i, tongue("left out", i), None) for i in range(20)]
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, documents(spark, good + odd), "").collect()}
    assert kept == {i for i, *_ in good}
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    planted = spark.createDataFrame([(10**9 + i, gibberish(i), None, "src0", 1) for i in range(50)], given.schema)
    kept = corpus_pipeline.language(spark, given.union(planted), "")
    assert kept.where(f"doc_id >= {10**9}").count() == 0 and kept.count() > 0.98 * given.count()


def test_language_stage_fuses_source_and_declared_language(spark):
    """Texts that read alike in three languages are kept where source or markup tells which."""
    weights = np.full((3, language.SLOTS), -np.log(language.SLOTS))
    slots = {k: np.unique(language.trigram_slots(k)) for k in ("wabo", "zeti", "muku")}
    for line, at in zip(weights, slots.values()):
        line[at] += 30
    model = language.TrigramModel(["a", "b", "c"], weights, np.array([[-20.0, 1.0, 1.0]] * 3))
    full = [(i, "wabo", "a", "only a", 4, "x", "y", 1, 2, "z") for i in range(50)]
    full += [(900 + i, "pilu", claim, source, 4, "x", "y", 1, 2, "z") for i, (claim, source) in enumerate([(None, "only a"), ("b", None), (None, None), ("b", "only a")])]
    full += [(i, k, k, "mixed", 4, "x", "y", 1, 2, "z") for i, k in [(500 + i, k) for i in range(50) for k in ("zeti", "muku")]]
    kept = {r["doc_id"] for r in language.keep_identified(spark.createDataFrame(full, SCHEMA), model).collect()}
    assert {900, 901} <= kept and 902 not in kept


def test_run_packs_what_is_left(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus).collect()
    assert {r["doc_id"] for r in rows} == {i for i in range(160) if i % 4} | {None}
    filled = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_empty_corpus(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_named_like_the_operators_own(spark, corpus):
    """Stages and the list join hand on columns whose names they use themselves."""
    docs = spark.read.parquet(f"{corpus}/documents.parquet").where("doc_id is null or doc_id < 60 or doc_id > 1000")
    own = ("of", "of_prior", "text_log", "text_fits", "fused_score", "claim", "aside", "copy", "_copy", "component_id", "n_shingles", "predicted", "given", "row")
    for name in own:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))))
    for name, stage in corpus_pipeline.STAGES[1:3]:
        kept = stage(spark, docs, corpus)
        assert kept.columns == docs.columns
        assert kept.count() > 0 and kept.exceptAll(docs).isEmpty(), name
    captures = spark.createDataFrame([("http://a.b.c/x", dt.datetime(2024, 1, 5))], "url string, fetched_at timestamp")
    names = ("_period", "seg_from", "seg_to", "_host", "_seg_period", "pattern", "aside", "step", "at")
    captures = captures.withColumns({n: F.lit(n) for n in names})
    entries = spark.createDataFrame([("l", "b.c", dt.datetime(2024, 1, 1), "add")], "list_name string, pattern string, dated_at timestamp, action string")
    row = url_lists.listed_captures(captures, entries).first()
    assert row["blocked"] and row["host"] == "a.b.c" and [row[n] for n in names] == list(names)
