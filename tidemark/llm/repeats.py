"""Passages that repeat, in one text or across texts, found by seed and extend.

A window is SPAN consecutive words. Of the hashes of its grams of GRAM words the smallest is
its anchor (winnowing): equal windows have equal anchors at equal places, and about one word in
fourteen is an anchor. A stretch is all windows of a text with the same anchor, in a row.

1. Seeds. Texts meet on their anchors. An anchor that occurs once can't lie in a repeat.
2. Extension both ways. Every occurrence of a shared anchor is extended to its whole stretch,
   left and right, as far as the anchor speaks for it. Stretches are told apart by a 128-bit
   fingerprint of their words, so the occurrences of an anchor fall into classes by one count;
   no pairs are formed, however many texts share a passage. In a class of several all windows
   repeat.
3. Where two classes share an anchor, matches end within the stretch. One member of each class
   is extended window by window, by 128-bit fingerprints again; a window that two classes hold
   repeats in both.
4. Windows that repeat and overlap are one maximal repeat of SPAN words or more, and their
   words go.

A text is read three times and shuffled twice by row number, both times in tables that are
deleted afterwards. A key that stands out (an anchor, a window in a third of all texts) is
counted by partial sums and looked up in a broadcast table of bounded size, the rest by a
shuffle whose keys are small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, looked_up, ship_package, small, stored, texts
from tidemark.llm.ngram_join import mix, powers

SPAN, GRAM = 35, 8
#: Grams in a window.
REACH = SPAN - GRAM + 1
#: Bytes of text whose words are hashed in one go.
CHUNK = 500_000

_random = np.random.default_rng(35)
_BYTES = _random.integers(0, 1 << 64, (2, 256), np.uint64)
_LEFT, _RIGHT, _SIZE = (int(x) | 1 for x in _random.integers(0, 1 << 63, 3))


class Words:
    """The words of some texts in a row: two hashes each, and where in the texts they lie."""

    def __init__(self, raw: list[bytes]):
        self.bytes = b" ".join(raw) + b" "
        byte = np.frombuffer(self.bytes, np.uint8)
        blank = (byte == 32) | ((byte >= 9) & (byte <= 13))
        edge = np.flatnonzero(np.diff(blank, prepend=True))
        self.starts, self.ends = edge[::2], edge[1::2]
        power, inverse = powers(len(byte) + 1)
        self.hashes = []
        for one in _BYTES:
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(one[byte] * power[: len(byte)])])
            self.hashes.append(mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts] + (self.ends - self.starts).astype(np.uint64)))
        #: The first word of each text, and one number more.
        self.first = np.searchsorted(self.starts, np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]))

    def text_of(self) -> np.ndarray:
        """The number of the text each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def chunks(raw: list[bytes]) -> Iterator[tuple[int, Words]]:
    """Texts, some at a time: the number of the first, and their words."""
    at = 0
    while at < len(raw):
        end, size = at, 0
        while end < len(raw) and (end == at or size + len(raw[end]) < CHUNK):
            size += len(raw[end]) + 1
            end += 1
        yield at, Words(raw[at:end])
        at = end


def grams(one: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` numbers in a row, put together from hashes of 1, 2, 4 and so on."""
    many, parts = len(one) - size + 1, [one]
    if many <= 0:
        return np.zeros(0, np.uint64)

    def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix(a * np.uint64(_LEFT) + (b ^ (b >> np.uint64(29))) * np.uint64(_RIGHT))

    while 2 << (len(parts) - 1) <= size:
        half, step = parts[-1], 1 << (len(parts) - 1)
        parts.append(both(half[: len(half) - step], half[step:]))
    found, at = None, 0
    for k in reversed(range(len(parts))):
        if size >> k & 1:
            part = parts[k][at : at + many]
            found, at = part if found is None else both(found, part), at + (1 << k)
    return found


def owners(gram: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Where the smallest of every ``reach`` numbers in a row lies; the first of equal ones."""
    at, width = np.arange(len(gram)), 1

    def less(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(gram[left] <= gram[right], left, right)

    while 2 * width <= reach:
        at, width = less(at[: len(at) - width], at[width:]), 2 * width
    return less(at[: len(at) - (reach - width)], at[reach - width :]) if reach > width else at


def stretches(words: Words) -> tuple[np.ndarray, ...]:
    """Per stretch: anchor, two fingerprints, number of the text, its first window's place in the text, windows."""
    one = words.hashes[0]
    if len(one) < SPAN:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    gram, text = grams(one, GRAM), words.text_of()
    owner = owners(gram)
    whole = text[: len(owner)] == text[SPAN - 1 :]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (text[1 : len(owner)] != text[: len(owner) - 1])
    new[1:] |= whole[1:] != whole[:-1]
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(owner))
    start, stop = start[whole[start]], stop[whole[start]]
    end = stop + SPAN - 1
    power, inverse = powers(len(one) + 1)
    prints = []
    for h in words.hashes:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[: len(h)])])
        prints.append(mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(_SIZE)))
    return gram[owner[start]], *prints, text[start], start - words.first[text[start]], stop - start


def seeds(documents: DataFrame) -> DataFrame:
    """(seed, high, low, row, at, many) of every stretch of (row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            ids = batch.column("row").to_numpy()
            for first, words in chunks([t.encode() for t in texts(batch)]):
                seed, high, low, text, at, many = stretches(words)
                yield pa.record_batch([
                    pa.array(seed.view(np.int64)), pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), pa.array(ids[first + text]),
                    pa.array(at.astype(np.int32)), pa.array(many.astype(np.int32)),
                ], names=["seed", "high", "low", "row", "at", "many"])

    return documents.select("row", "text").mapInArrow(run, "seed long, high long, low long, row long, at int, many int")


def windows(documents: DataFrame) -> DataFrame:
    """(high, low, row, at) of the windows of (row, text, stretches), an array of (at, many)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            ids, asked = batch.column("row").to_numpy(), batch.column("stretches").to_pylist()
            for first, words in chunks([t.encode() for t in texts(batch)]):
                texts_, at = [], []
                for k in range(len(words.first) - 1):
                    for s in asked[first + k]:
                        at.append(np.arange(s["at"], s["at"] + s["many"], dtype=np.int32))
                        texts_.append(np.full(s["many"], k))
                if not at:
                    continue
                at, text = np.concatenate(at), np.concatenate(texts_)
                place = words.first[text] + at
                high, low = (grams(h, SPAN)[place].view(np.int64) for h in words.hashes)
                yield pa.record_batch([pa.array(high), pa.array(low), pa.array(ids[first + text]), pa.array(at)], names=["high", "low", "row", "at"])

    return documents.select("row", "text", "stretches").mapInArrow(run, "high long, low long, row long, at int")


def repeats(scratch: Scratch, documents: DataFrame) -> DataFrame:
    """(row, at, until): words of (row, text), numbered from 0, that windows with a twin cover; may overlap."""
    found = scratch.keep(seeds(documents))
    total = found.count()
    first = F.min(F.struct("row", "at", "many")).alias("first")
    classes = scratch.keep(found.groupBy("seed", "high", "low").agg(F.count("*").alias("n"), first))
    whole = looked_up(found, classes.where("n > 1").select("high", "low", "n"), ["high", "low"], total)
    whole = scratch.keep(whole.select("row", "at", (F.col("at") + F.col("many") + SPAN - 1).alias("until")))
    # Anchors with several classes: one member of each goes on.
    split = classes.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1")
    members = looked_up(classes.drop("n"), split, ["seed"], total)
    members = members.select("first.*").groupBy("row").agg(F.collect_list(F.struct("at", "many")).alias("stretches"))
    each = scratch.keep(windows(documents.join(members, "row")))
    del members, split
    scratch.release(found, classes)
    total = each.count()
    twins = scratch.keep(each.groupBy("high", "low").agg(F.count("*").alias("n")).where("n > 1"))
    part = scratch.keep(looked_up(each, twins, ["high", "low"], total).select("row", "at", (F.col("at") + SPAN).alias("until")))
    scratch.release(each, twins)
    return whole.union(part)


def cut(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words outside all spans, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            raw, gone = [t.encode() for t in texts(batch)], batch.column("spans").to_pylist()
            count, removed, kept = [], [], []
            for text, spans_ in zip(raw, gone):
                words = text.split()
                count.append(len(words))
                if spans_:
                    turn = np.zeros(len(words) + 1, np.int64)
                    np.add.at(turn, [s["at"] for s in spans_], 1)
                    np.add.at(turn, [s["until"] for s in spans_], -1)
                    stay = np.cumsum(turn[:-1]) == 0
                    words = [w for w, s in zip(words, stay.tolist()) if s]
                removed.append(count[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.record_batch([batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    met = documents.join(spans.groupBy("row").agg(F.collect_list(F.struct("at", "until")).alias("spans")), "row", "left")
    return met.select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def without_repeats(scratch: Scratch, documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row of (doc_id, text), all its repeats removed.

    Words lie between blanks, tabs and line ends and are compared unchanged. Every copy of a
    passage of SPAN words or more goes, the first one too, and within one text as well. Null
    and empty texts have no words; texts shorter than SPAN words keep all. Rows are told apart by
    their place, so repeated rows and rows without doc_id repeat each other like any others.
    """
    spark = documents.sparkSession
    ship_package(spark)
    rows = scratch.keep(documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))
    return cut(rows, repeats(scratch, rows))


def op12_repeats(spark: SparkSession, documents: DataFrame) -> DataFrame:
    with Scratch(spark, "repeats") as scratch:
        rows = without_repeats(scratch, documents)
        return stored(rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")), "without-repeats")


OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
starts AS (SELECT r, w, unnest(range(1, len(w) - {SPAN - 2})) AS s FROM d WHERE len(w) >= {SPAN}),
windows AS (SELECT r, s, sha256(array_to_string(list_slice(w, s, s + {SPAN - 1}), ' ')) AS h FROM starts),
twins AS (SELECT r, s FROM (SELECT *, count(*) OVER (PARTITION BY h) AS n FROM windows) WHERE n > 1),
words AS (SELECT r, i, w[i] AS x FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
marked AS (
  SELECT r, i, x, max(t.s) OVER (PARTITION BY words.r ORDER BY i ROWS BETWEEN {SPAN - 1} PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM words LEFT JOIN (SELECT r AS tr, s FROM twins) t ON t.tr = words.r AND t.s = words.i
),
kept AS (SELECT r, count(*) AS n, count(*) FILTER (gone) AS k, string_agg(x, ' ' ORDER BY i) FILTER (NOT gone) AS t FROM marked GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(k, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
"""
