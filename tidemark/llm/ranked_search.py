"""Ranked lexical search: the best documents for every item, by summed term weights.

Documents are dealt over tasks, and a task holds the inverted lists of its own documents, a
segment at a time. So a word in a third of all texts is spread like any other, and what leaves
a task is the best TOP documents per item.

Within a segment an item goes term at a time first, then document at a time:

1. The lists of its rare terms are short. They are summed into accumulators.
2. The accumulators are one list more, bounded by their largest entry. Together with the long
   lists, each bounded by its largest entry, it is walked in windows of documents. Lists are
   ordered by bound; those in front whose bounds together stay below the score of the TOP-th
   best document so far can't bring a document in by themselves and are skipped over: only the
   documents of the other lists are scored, and looked up in the skipped ones by binary search,
   the largest bound first, as long as they can still get in.

The threshold is carried from window to window and from segment to segment of a task, and
starts from the accumulators. Bounds are whole numbers and never too low, so the result is exact.

The items' terms are broadcast in blocks of about BLOCK (item, term) pairs; documents are read
once per block and their terms in the block's vocabulary written to the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, ship_package, small, stored, texts

TOP = 50
#: (item, term) pairs that are broadcast at once, about.
BLOCK = 200_000
#: Postings of a segment, about; documents of a window; a list is short below this share of a segment.
SEGMENT, WINDOW, SHORT = 2_000_000, 4_096, 1 / 32

#: Letters and digits of ASCII and all other characters make terms; A to Z count as a to z.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode().translate(TERMS).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [list(dict.fromkeys(terms(t))) for t in texts(batch)]
            many = np.array([len(f) for f in found])
            ids = batch.column("item_id").take(pa.array(np.repeat(np.arange(len(found)), many)))
            yield pa.record_batch([ids, pa.array([t for f in found for t in f], pa.binary())], names=["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, term binary").distinct()


def postings(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts): per document its length and the terms of the vocabulary in it.

    The last row of a task has n = -1 and tells how many of its documents hold each term.
    """
    known = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, holds = known.value.get, np.zeros(len(known.value), np.int64)

        def out(ids: pa.Array, sizes: list[int], found: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
            ends = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(part), kind)) for part, kind in ((found, pa.int32()), (counts, pa.int64()))]
            return pa.record_batch([ids, pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])

        for batch in small(batches):
            sizes, found, counts = [], [], []
            for text in texts(batch):
                words = terms(text)
                sizes.append(len(words))
                term, count = np.unique(np.array([i for i in map(get, words) if i is not None], np.int32), return_counts=True)
                holds[term] += 1
                found.append(term)
                counts.append(count)
            yield out(batch.column("doc_id"), sizes, found, counts)
        held = np.flatnonzero(holds)
        yield out(pa.array([None], pa.int64()), [-1], [held.astype(np.int32)], [holds[held]])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


class Best:
    """The best documents of one item so far: scores, ids (null as the smallest)."""

    def __init__(self, top: int):
        self.top, self.score, self.doc, self.bar = top, np.zeros(0, np.int64), np.zeros(0, np.int64), 1

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        self.score, self.doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        if len(self.score) > self.top:
            keep = np.lexsort((self.doc, -self.score))[: self.top]
            self.score, self.doc = self.score[keep], self.doc[keep]
        if len(self.score) == self.top:
            self.bar = max(self.bar, int(self.score.min()))


class Segment:
    """Inverted lists of some documents: (documents, impacts) per term."""

    def __init__(self, doc: np.ndarray, soft: np.ndarray, many: np.ndarray, term: np.ndarray, count: np.ndarray, weight: np.ndarray):
        """``soft`` is a document's m, ``many`` its number of postings, which lie in a row."""
        self.doc = doc
        place = np.repeat(np.arange(len(doc)), many)
        impact = weight[term] * ((1_000_000_000 * count) // (1000 * count + 20 * soft[place]))
        order = np.argsort(term, kind="stable")
        self.place, self.impact, term = place[order], impact[order], term[order]
        self.terms = np.unique(term)
        self.edge = np.append(np.searchsorted(term, self.terms), len(term))
        self.bound = np.maximum.reduceat(self.impact, self.edge[:-1]) if len(term) else np.zeros(0, np.int64)
        self.sums = np.zeros(len(doc), np.int64)

    def search(self, item: np.ndarray, best: Best) -> None:
        at = np.searchsorted(self.terms, item)
        at = [k for k, t in zip(at.tolist(), item.tolist()) if k < len(self.terms) and self.terms[k] == t and self.bound[k] > 0]
        lists = [(int(self.bound[k]), self.place[self.edge[k] : self.edge[k + 1]], self.impact[self.edge[k] : self.edge[k + 1]]) for k in at]
        few = max(64, int(len(self.doc) * SHORT))
        for _, place, impact in lists:
            if len(place) <= few:
                self.sums[place] += impact
        touched = np.flatnonzero(self.sums)
        held = self.sums[touched]
        self.sums[touched] = 0
        lists = [one for one in lists if len(one[1]) > few]
        if len(touched):
            lists.append((int(held.max()), touched, held))
            if len(held) >= best.top:
                best.bar = max(best.bar, int(np.partition(held, len(held) - best.top)[len(held) - best.top]))
        if lists:
            self.walk(sorted(lists, key=lambda one: one[0]), best)

    def walk(self, lists: list[tuple[int, np.ndarray, np.ndarray]], best: Best) -> None:
        """Document at a time over lists by ascending bound, in windows of documents."""
        together = np.cumsum([bound for bound, _, _ in lists])
        edges = np.append(np.arange(0, len(self.doc), WINDOW), len(self.doc))
        cuts = [np.searchsorted(place, edges) for _, place, _ in lists]
        for w in range(len(edges) - 1):
            skip = int(np.searchsorted(together, best.bar))
            if skip == len(lists):
                return
            score = np.zeros(edges[w + 1] - edges[w], np.int64)
            for (_, place, impact), cut in zip(lists[skip:], cuts[skip:]):
                part = slice(cut[w], cut[w + 1])
                score[place[part] - edges[w]] += impact[part]
            found = np.flatnonzero(score)
            score = score[found]
            for k in reversed(range(skip)):
                able = score + together[k] >= best.bar
                found, score = found[able], score[able]
                if not len(found):
                    break
                _, place, impact = lists[k]
                part = slice(cuts[k][w], cuts[k][w + 1])
                if part.start < part.stop:
                    hit = np.minimum(np.searchsorted(place[part], found + edges[w]), part.stop - part.start - 1)
                    score += np.where(place[part][hit] == found + edges[w], impact[part][hit], 0)
            able = score >= best.bar
            if able.any():
                best.add(score[able], self.doc[found[able] + edges[w]])


def softening(n: np.ndarray, rows: int, length: int) -> np.ndarray:
    """A document's m: half of it even, half by its length against the mean."""
    return 100 - 50 + (50 * n * rows) // length


def searched(index: DataFrame, items: list[np.ndarray], weight: np.ndarray, rows: int, length: int, top: int) -> DataFrame:
    """(item, doc_id, score): the best of every task for every item, by number."""
    sent = index.sparkSession.sparkContext.broadcast((items, weight))
    null = np.iinfo(np.int64).min

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = sent.value
        best, held, postings_ = [Best(top) for _ in asked], [], 0

        def search() -> None:
            doc, n, many, term, count = (np.concatenate(part) for part in zip(*held))
            segment = Segment(doc, softening(n, rows, length), many, term, count, weights)
            for item, one in zip(asked, best):
                segment.search(item, one)

        for batch in small(batches):
            term, count = batch.column("terms"), batch.column("counts")
            held.append((
                batch.column("doc_id").fill_null(int(null)).to_numpy(), batch.column("n").to_numpy(), np.asarray(term.value_lengths(), np.int64),
                term.flatten().to_numpy(), count.flatten().to_numpy(),
            ))
            postings_ += len(held[-1][3])
            if postings_ > SEGMENT:
                search()
                held, postings_ = [], 0
        if held:
            search()
        number = np.repeat(np.arange(len(best), dtype=np.int32), [len(b.doc) for b in best])
        doc = np.concatenate([np.zeros(0, np.int64), *(b.doc for b in best)])
        score = np.concatenate([np.zeros(0, np.int64), *(b.score for b in best)])
        yield pa.record_batch([pa.array(number), pa.array(doc, mask=doc == null), pa.array(score)], names=["item", "doc_id", "score"])

    return index.mapInArrow(run, "item int, doc_id long, score long")


def ranked_search(documents: DataFrame, items: DataFrame, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of (doc_id, text) per item of (item_id, text).

    Only scores above 0 count, so an item without terms, or whose terms no document holds, has
    no rows; nor have empty tables. Equal scores go by ascending doc_id, rows without doc_id
    first. Repeated documents are ranked each. Items that share an item_id are one item with
    the terms of all of them, as are those without one. Null texts have no terms. Other columns
    are not looked at.
    """
    spark = documents.sparkSession
    ship_package(spark)
    with Scratch(spark, "search") as scratch:
        pairs = scratch.keep(item_terms(items))
        blocks = -(-pairs.count() // block)
        kind = items.schema["item_id"].dataType.simpleString()
        found = [scratch.keep(spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long"))]
        for number in range(blocks):
            # About ``block`` pairs: whole items, dealt by hash.
            mine = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).collect()
            if not mine:
                continue
            ids = {i: k for k, i in enumerate(dict.fromkeys(r["item_id"] for r in mine))}
            vocabulary = {t: k for k, t in enumerate(sorted({bytes(r["term"]) for r in mine}))}
            asked = [[] for _ in ids]
            for r in mine:
                asked[ids[r["item_id"]]].append(vocabulary[bytes(r["term"])])
            index = scratch.keep(postings(documents, vocabulary))
            rows = index.where("n > 0")
            rows_, length = rows.agg(F.count("*"), F.sum("n")).first()
            if not rows_:
                break
            # One number per term of the block.
            df = np.zeros(len(vocabulary), np.int64)
            for r in index.where("n = -1").select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("df")).collect():
                df[r["terms"]] = r["df"]
            weight = np.array([math.floor(1000 * math.log((2 * rows_ + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
            best = scratch.keep(searched(rows, [np.array(sorted(a)) for a in asked], weight, rows_, length, top))
            names = spark.createDataFrame([(k, i) for i, k in ids.items()], f"number int, item_id {kind}")
            order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
            ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            found.append(scratch.keep(ranked.join(names, F.col("item") == F.col("number")).select("item_id", "rank", "doc_id", "score")))
            scratch.release(index, best)
        union = found[0]
        for one in found[1:]:
            union = union.union(one)
        return stored(union, "ranked")


def op13_search(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return ranked_search(documents, benchmark)


_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_TERMS}, []) AS terms FROM documents),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
tf AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, doc_id, n, t),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, corpus GROUP BY t, n_docs),
scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN w USING (t), corpus GROUP BY item_id, r, doc_id
)
SELECT * FROM (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
) WHERE rank <= {TOP}
"""
