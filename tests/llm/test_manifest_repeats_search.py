"""op11, op12 and op13 against plain Python, on edge cases and on the given tables against SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import documents, prose
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import compare, connect
from tidemark.llm import common, merkle, ranked_search, repeats
from tidemark.llm.common import Scratch

NEW = ("op11_merkle", "op12_repeats", "op13_search")


@pytest.mark.parametrize("name", NEW)
def test_against_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), name, sf_dir) == ""


def test_intermediate_tables_are_deleted(spark):
    with Scratch(spark, "some") as scratch:
        kept = scratch.keep(spark.range(3))
        assert kept.count() == 3
    with pytest.raises(Exception, match="(?i)not exist|no such file"):
        kept.count()


# Merkle manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves, arity):
    """Root, and each leaf's proof as a list of (left siblings, right siblings)."""
    ways, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i // arity * arity :][:arity]
            ways[k].append((run[: i % arity], run[i % arity + 1 :]))
        level, at = [h("".join(level[i : i + arity])) for i in range(0, len(level), arity)], [i // arity for i in at]
    return level[0], ways


def plain_manifest(rows, arity):
    """doc_id, leaf, subroot, root, proof, folded root, verified of (doc_id, text, lang, source, n_chars)."""
    teams = defaultdict(list)
    for i, text, lang, source, n in rows:
        claim = n + 1 if n is not None and i is not None and zlib.crc32(str(i).encode()) % 7 == 0 else n
        leaf, false = ("".join(map(field, (i, source, lang, m, text))) for m in (n, claim))
        teams[lang].append(((i is not None, i or 0), h(leaf), h(false), i))
    order = sorted(teams, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in order:
        teams[lang].sort(key=lambda row: row[:2])
        trees[lang] = plain_tree([row[1] for row in teams[lang]], arity)
    root, top = plain_tree([trees[lang][0] for lang in order], arity)
    out = []
    for lang, above in zip(order, top):
        for (_, leaf, claim, i), way in zip(teams[lang], trees[lang][1]):
            fold = claim
            for left, right in way + above:
                fold = h("".join([*left, fold, *right]))
            proof = h("".join(x for left, right in way + above for x in left + right))
            out.append((i, leaf, trees[lang][0], root, proof, fold, fold == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [1, 2, 3, 13])
def test_manifest_of_few_rows(spark, size):
    rows = [(i * 3, f"text {i}", ("en", "de", None, "ß")[i % 3 if i < 9 else 3]) for i in range(size)]
    df = documents(spark, rows)
    want = plain_manifest([(i, t, k, "s", len(t)) for i, t, k in rows], 2)
    assert sorted(map(tuple, merkle.op11_merkle(spark, df).collect()), key=repr) == want


def test_manifest_of_edge_cases(spark, edge):
    """Nulls everywhere, repeated rows, long texts, and columns named like the operator's own."""
    df = edge.withColumn("n_chars", F.when(F.col("doc_id") != 4, F.col("n_chars"))).repartition(5)
    for name in ("team", "key", "h", "claim", "g", "i", "n", "at", "part", "step", "o"):
        df = df.withColumn(name, F.lit(name))
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()]
    got = sorted(map(tuple, merkle.op11_merkle(spark, df).collect()), key=repr)
    assert got == plain_manifest(rows, 2)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("arity", [3, 7])
def test_wider_runs(spark, arity):
    rows = [(i, f"text {i}", "en" if i < 40 else None) for i in range(61)]
    df = documents(spark, rows).repartition(4)
    presented = {"n_chars": F.col("n_chars") + F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, 1).otherwise(0)}
    found = merkle.merkle_manifest(df, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", arity, presented)
    found = found.select("key", "leaf", "root", "others", merkle.folded(F.col("claim"), F.col("steps"), F.col("others")).alias("fold")).collect()
    want = {r[0]: r for r in plain_manifest([(i, t, k, "s", len(t)) for i, t, k in rows], arity)}
    assert len(found) == len(want)
    for r in found:
        _, leaf, _, root, proof, fold, _ = want[r["key"]]
        assert (r["leaf"].hex(), r["root"].hex(), h(r["others"].hex()), r["fold"].hex()) == (leaf, root, proof, fold)


def test_manifest_of_nothing(spark, nothing):
    assert merkle.op11_merkle(spark, nothing).collect() == []
    with pytest.raises(ValueError, match="arity"):
        merkle.merkle_manifest(nothing, ["text"], "lang", "doc_id", 1)


# Repeated passages


def plain_repeats(rows, span=repeats.SPAN):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    count = Counter(tuple(w[s : s + span]) for w in words for s in range(len(w) - span + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for s in range(len(w) - span + 1):
            if count[tuple(w[s : s + span])] > 1:
                gone.update(range(s, s + span))
        out.append((i, len(w), len(gone), h(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=repr)


def test_windows_own_one_anchor_wherever_they_lie():
    rng = np.random.default_rng(1)
    gram = rng.integers(0, 50, 400).astype(np.uint64)
    got = repeats.owners(gram)
    assert got.tolist() == [s + int(np.argmin(gram[s : s + repeats.REACH])) for s in range(len(gram) - repeats.REACH + 1)]
    one = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    for size in (1, 2, 7, 8, 35):
        whole = repeats.grams(one, size)
        assert len(whole) == 60 - size + 1
        assert [repeats.grams(one[s : s + size], size)[0] for s in range(60 - size + 1)] == whole.tolist()


def shared_passages(seed):
    """Texts that share passages of 30 to 60 words in varied surroundings, some with one word changed."""
    rng = random.Random(seed)
    passages = [prose(900 + k, n).split() for k, n in enumerate((30, 34, 35, 36, 50, 60))]
    passages.append(["same"] * 80)
    rows = []
    for i in range(120):
        words = prose(i, rng.choice((0, 3, 20, 60))).split()
        for _ in range(rng.randrange(4)):
            part = list(rng.choice(passages))
            if rng.random() < 0.4:
                part[rng.randrange(len(part))] = f"new{rng.random()}"
            if rng.random() < 0.3:
                part = part[rng.randrange(20) :]
            words += part + prose(rng.randrange(10**6), rng.choice((0, 1, 30))).split()
        rows.append((i if i % 17 else None, rng.choice((" ", "\n", "  ", "\t")).join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_against_every_window(spark, seed, monkeypatch):
    if seed == 3:  # keys of three rows count as hot
        monkeypatch.setattr(common, "FEW", 2)
        monkeypatch.setattr(common, "HOT", 10**6)
    rows = shared_passages(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for name in ("row", "seed", "at", "many", "high", "low", "spans", "stretches", "first", "n"):
        df = df.withColumn(name, F.lit(name))
    assert sorted(map(tuple, repeats.op12_repeats(spark, df).collect()), key=repr) == plain_repeats(rows)


def test_repeats_of_edge_cases(spark, edge, nothing):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert sorted(map(tuple, repeats.op12_repeats(spark, edge).collect()), key=repr) == plain_repeats(rows)
    assert repeats.op12_repeats(spark, nothing).collect() == []


# Ranked search


def plain_search(docs, items, top=ranked_search.TOP):
    def terms(text):
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    held = [(i, Counter(terms(t))) for i, t in docs]
    rows, length = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = []
    for item, words in asked.items():
        scores = []
        for i, c in held:
            m = 100 - 50 + (50 * c.total() * rows) // length if length else 0
            score = sum(math.floor(1000 * math.log((2 * rows + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in words if c[t])
            if score > 0:
                scores.append((-score, i is not None, i or 0, i))
        out += [(item, k + 1, i, -score) for k, (score, _, _, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("way", ["whole", "windows", "segments", "blocks"])
def test_search_against_all_documents(spark, way, monkeypatch):
    if way == "windows":
        monkeypatch.setattr(ranked_search, "WINDOW", 16)
        monkeypatch.setattr(ranked_search, "SHORT", 0.01)
    if way == "segments":
        monkeypatch.setattr(ranked_search, "SEGMENT", 200)
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(120)]
    docs = [(i if i % 11 else None, " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(120)], k=rng.choice((0, 5, 40, 300))))) for i in range(600)]
    docs += docs[40:60] + [(5000, "W1 W2-w3 é É")]
    items = [(k, " ".join(rng.sample(vocabulary, 12))) for k in range(25)] + [(None, "w1 w2"), (3, "extra é"), (90, None), (91, "absent"), (92, "...")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    for name in ("item", "rank", "score", "n", "terms", "counts", "term", "number"):
        df, asked = df.withColumn(name, F.lit(name)), asked.withColumn(name, F.lit(name))
    got = ranked_search.ranked_search(df, asked, block=60 if way == "blocks" else ranked_search.BLOCK)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_search(docs, items)


def test_search_over_edge_cases(spark, edge, nothing):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    items = [(1, "hello word text"), (2, "x" * 60_000), (3, "テキスト naïve Ça")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, ranked_search.op13_search(spark, edge, asked).collect()), key=repr) == plain_search(rows, items)
    assert ranked_search.op13_search(spark, nothing, asked).collect() == []
    assert ranked_search.op13_search(spark, edge, asked.limit(0)).collect() == []
    assert set(NEW) <= set(entry.queries())
