"""Jaccard join on sets of word shingles with several global token orders.

Two sets with a Jaccard similarity of t or more share a token among the first
``n - ceil(t n) + 1`` of each, whatever global order the tokens are put in. Under one
order many pairs pass by chance or for a common passage; a candidate has to pass under all
of several orders. Each order puts rare tokens first: tokens are counted over the whole
corpus in hashed buckets (another hash for each order), so a frequent token goes to the
end, and ties go by a hash of the token.

1. Every text's shingle set is computed once for its size and a 128-bit digest, and once for
   its prefix under the first order. Equal sets are one node, named by its smallest doc_id.
2. Prefix tokens meet (the only large shuffle). In a group each member is paired with one
   hub and with its neighbour: linear in the group, and enough to join most of what belongs
   together.
3. Those pairs are verified, and components formed. In further rounds each member outside
   the largest component of its token is paired with another hub inside.
4. What is left to decide are pairs across components: per token, the members outside its
   largest component meet the others. All of them that pass the size, position and parity
   filters are verified, so no link is lost, but a large group of near copies never lists its inner
   pairs.

Verification brings the two (compressed) texts together, checks the prefixes of the other
orders, and then intersects the sets. The parity filter needs 512 bits of either set and comes
before any text is moved: bits that differ are tokens only one set has. A token that stands out in the counts is dealt by
slices of documents; their hubs are paired in turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, looked_up, ship_package, small, stored, texts
from tidemark.llm.components import components

WORDS, ORDERS, BUCKETS, SLICE_ROWS = 5, 3, 1 << 14, 20_000
#: Rounds that pair what is still outside with a hub inside, before all that is left is decided.
HUB_ROUNDS = 2
#: Similarity as a fraction.
NUMERATOR, DENOMINATOR = 4, 5
#: Bytes of text whose words are hashed in one go.
CHUNK = 500_000
#: Bits that tell sets apart.
PARITY = 512

_random = np.random.default_rng(20240101)
_BYTE = _random.integers(0, 1 << 64, 256, np.uint64)
_BASE = int(_random.integers(0, 1 << 63)) * 2 + 1
_PLACE = _random.integers(0, 1 << 64, WORDS, np.uint64) | np.uint64(1)
_ORDER = _random.integers(0, 1 << 64, ORDERS, np.uint64)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that scatters 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < size:
        size = max(size, CHUNK + CHUNK // 2)
        _powers[:] = [
            np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, base, np.uint64))]) for base in (_BASE, pow(_BASE, -1, 1 << 64))
        ]
    return _powers


def shingle_sets(raw: list[bytes]) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of five words, A to Z in lower case.

    Fewer words are one shingle; no words, an empty set. Words are what lies between blanks,
    tabs and line ends. All words of a chunk are hashed at once, by differences of running sums.
    """
    at = 0
    while at < len(raw):
        end, size = at, 0
        while end < len(raw) and (end == at or size + len(raw[end]) < CHUNK):
            size += len(raw[end]) + 1
            end += 1
        yield from _chunk_sets(raw[at:end])
        at = end


def _chunk_sets(raw: list[bytes]) -> Iterator[np.ndarray]:
    byte = np.frombuffer(b" ".join(raw).lower() + b" ", np.uint8)
    blank = (byte == 32) | ((byte >= 9) & (byte <= 13))
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    power, inverse = powers(len(byte) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[byte] * power[: len(byte)])])
    word = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    count = max(0, len(word) - WORDS + 1)
    five = np.zeros(count, np.uint64)
    for k in range(WORDS):
        five += mix(word[k : k + count] ^ _PLACE[k]) * _PLACE[k]
    five = mix(five)
    bounds = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    first = np.searchsorted(starts, bounds)
    for a, b in zip(first.tolist(), first[1:].tolist()):
        if b - a >= WORDS:
            yield np.unique(five[a : b - WORDS + 1])
        elif b > a:
            few = word[a:b]
            yield mix(np.bitwise_xor.reduce(mix(few + np.arange(1, b - a + 1, dtype=np.uint64) * _PLACE[0]), keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def bucket(tokens: np.ndarray, order: int) -> np.ndarray:
    return (mix(tokens ^ _ORDER[order]) % np.uint64(BUCKETS)).astype(np.int64)


def prefix(tokens: np.ndarray, order: int, ranks: np.ndarray) -> np.ndarray:
    """The prefix of a set under one order: tokens of rarer buckets first, then by their hash."""
    key = ranks[order, bucket(tokens, order)].astype(np.uint64) << np.uint64(48) | mix(tokens + _ORDER[order]) >> np.uint64(16)
    n = len(tokens)
    return tokens[np.argsort(key, kind="stable")[: n - -(-NUMERATOR * n // DENOMINATOR) + 1]]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both)


def parity(tokens: np.ndarray) -> bytes:
    """For each of PARITY buckets, whether an odd number of a set's tokens fall into it.

    Where two sets' bits differ there is at least one token that only one of them has.
    """
    odd = np.bincount((mix(tokens ^ _PLACE[0]) % np.uint64(PARITY)).astype(np.int64), minlength=PARITY).astype(np.uint8) & 1
    return np.packbits(odd).tobytes()


def measured(documents: DataFrame, scratch: Scratch) -> tuple[DataFrame, np.ndarray]:
    """Kept (doc_id, n, high, low, parity): size and digests of each row's set; and the bucket counts of all orders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((ORDERS, BUCKETS), np.int64)
        for batch in small(batches):
            raw, sizes, digests, bits, held, many = [t.encode() for t in texts(batch)], [], [], [], [], 0
            for tokens in shingle_sets(raw):
                sizes.append(len(tokens))
                digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                bits.append(parity(tokens))
                held.append(tokens)
                many += len(tokens)
                if many > 1_000_000 or len(sizes) == len(raw):
                    every = np.concatenate(held)
                    for order in range(ORDERS):
                        counts[order] += np.bincount(bucket(every, order), minlength=BUCKETS)
                    held, many = [], 0
            pairs = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.record_batch([
                pa.array([True] * len(raw)), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]),
                pa.array(np.frombuffer(b"".join(bits), "<i8").reshape(-1, PARITY // 64).tolist(), pa.list_(pa.int64())),
            ], names=["row", "doc_id", "n", "high", "low", "parity"])
        order, slot = np.nonzero(counts)
        yield pa.record_batch([
            pa.array(np.zeros(len(order), bool)), pa.array(order, pa.int64()), pa.array(counts[order, slot]), pa.array(slot, pa.int64()), pa.array(order, pa.int64()),
            pa.nulls(len(order), pa.list_(pa.int64())),
        ], names=["row", "doc_id", "n", "high", "low", "parity"])

    ship_package(documents.sparkSession)
    both = scratch.keep(documents.select("doc_id", "text").mapInArrow(run, "row boolean, doc_id long, n long, high long, low long, parity array<long>"))
    counts = np.zeros((ORDERS, BUCKETS), np.int64)
    # One number per order and bucket, however many documents there are.
    for r in both.where("not row").groupBy(F.col("low").alias("o"), F.col("high").alias("b")).agg(F.sum("n").alias("n")).collect():
        counts[r["o"], r["b"]] = r["n"]
    return both.where("row").drop("row"), counts


def postings(documents: DataFrame, counts: np.ndarray, ranks: np.ndarray) -> DataFrame:
    """(token, salt, salts, doc_id, n, pos): prefix tokens under the first order.

    A token whose bucket stands out is dealt into slices of about SLICE_ROWS documents.
    """
    mean = counts[0].mean()
    above = np.maximum(0, counts[0] - mean - 6 * np.sqrt(mean))
    slices = (1 + above // SLICE_ROWS).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            ids = batch.column("doc_id").to_pylist()
            token, doc, size, place, held = [], [], [], [], 0
            for i, tokens in zip(ids, shingle_sets([t.encode() for t in texts(batch)])):
                if i is not None and len(tokens):
                    token.append(prefix(tokens, 0, ranks))
                    doc.append(i)
                    size.append(len(tokens))
                    held += len(token[-1])
                if held > 500_000:
                    yield out(token, doc, size)
                    token, doc, size, held = [], [], [], 0
            if token:
                yield out(token, doc, size)

    def out(token: list[np.ndarray], doc: list[int], size: list[int]) -> pa.RecordBatch:
        many = np.array([len(t) for t in token])
        every, ids = np.concatenate(token), np.repeat(np.array(doc, np.int64), many)
        salts = slices[bucket(every, 0)]
        salt = (mix(ids.view(np.uint64)) % salts.astype(np.uint64)).astype(np.int64)
        return pa.record_batch([
            pa.array(every.view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(salts.astype(np.int32)), pa.array(ids),
            pa.array(np.repeat(np.array(size, np.int32), many)), pa.array(np.concatenate([np.arange(m, dtype=np.int32) for m in many])),
        ], names=["token", "salt", "salts", "doc_id", "n", "pos"])

    schema = "token long, salt int, salts int, doc_id long, n int, pos int"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def may_link(a: str, b: str):
    """Size and position filter on structs (doc_id, n, pos) that share a token at these places.

    What two sets have in common from a shared token on can't exceed what the shorter has left.
    It holds at the first token a pair shares, so some shared token passes for every pair that links.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    rest = F.least(n - F.col(f"{a}.pos"), m - F.col(f"{b}.pos"))
    sizes = (DENOMINATOR * F.least(n, m)) >= NUMERATOR * F.greatest(n, m)
    return sizes & ((NUMERATOR + DENOMINATOR) * rest >= NUMERATOR * (n + m))


def may_agree(a: str, b: str):
    """Parity filter on structs (n, parity): of two sets that link, at most (n + m) / 9 tokens are in one of them only."""
    apart = sum((F.bit_count(F.col(f"{a}.parity")[k].bitwiseXOR(F.col(f"{b}.parity")[k])) for k in range(PARITY // 64)), F.lit(0))
    return (NUMERATOR + DENOMINATOR) * apart <= (DENOMINATOR - NUMERATOR) * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def verified(pairs: DataFrame, packed: DataFrame, ranks: np.ndarray, scratch: Scratch) -> DataFrame:
    """Kept (a, b) of the pairs that link. ``packed`` (doc_id, packed): compressed texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in small(batches):
            ones, others = batch.column("packed_a").to_pylist(), batch.column("packed_b").to_pylist()
            blobs = list(dict.fromkeys(ones + others))
            known = dict(zip(blobs, shingle_sets([unpack(x) for x in blobs])))
            fronts = {x: [prefix(tokens, order, ranks) for order in range(1, ORDERS)] for x, tokens in known.items()}
            good = [
                all(len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(fronts[one], fronts[other])) and similar(known[one], known[other])
                for one, other in zip(ones, others)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = packed.select(F.col("doc_id").alias("a"), F.col("packed").alias("packed_a"))
    right = packed.select(F.col("doc_id").alias("b"), F.col("packed").alias("packed_b"))
    met = pairs.hint("merge").join(left.hint("merge"), "a").hint("merge").join(right.hint("merge"), "b")
    return scratch.keep(met.select("a", "b", "packed_a", "packed_b").mapInArrow(run, "a long, b long"))


def packed_texts(documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1).compress
        for batch in small(batches):
            yield pa.record_batch([batch.column("doc_id"), pa.array([press(t.encode()) for t in texts(batch)], pa.binary())], names=["doc_id", "packed"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, packed binary")


def ngram_links(documents: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, n, high, low) of all documents; the sets among them (n, high, low, node, copies);
    and (node, root) of the nodes in components of several.

    ``node`` is the smallest doc_id with that set.
    """
    rows, counts = measured(documents, scratch)
    ranks = np.stack([np.unique(c, return_inverse=True)[1] for c in counts])
    known = rows.where("n > 0 and doc_id is not null")
    nodes = scratch.keep(known.groupBy("n", "high", "low").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")))
    node_of = scratch.keep(looked_up(known, nodes, ["n", "high", "low"], rows.count(), "copies").select("doc_id", "node").distinct())
    # Rows that share a doc_id may have several sets; the parity filter leaves such a node alone.
    sketch = known.join(nodes.select("node").distinct(), F.col("doc_id") == F.col("node"), "left_semi").groupBy("doc_id").agg(
        F.max(F.struct("n", "parity")).alias("s"), F.count_distinct("high", "low").alias("sets")
    ).select(F.col("doc_id").alias("node"), F.when(F.col("sets") == 1, F.col("s.parity")).alias("parity"))

    group = Window.partitionBy("token", "salt").orderBy(F.xxhash64("token", "doc_id"), "doc_id")
    me = F.struct("doc_id", "n", "pos")
    shared = scratch.keep(
        postings(documents, counts, ranks).select(
            "token", "salts", me.alias("me"), F.lag(me).over(group).alias("before"), F.lead("doc_id").over(group).alias("after"),
            F.first(me).over(group.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("hub"),
        ).where("before is not null or after is not null or salts > 1")
    )
    heads = shared.where("salts > 1 and before is null").select("me", F.lag("me").over(Window.partitionBy("token").orderBy("me.doc_id")).alias("other"))
    first = shared.select("me", F.explode(F.array("before", "hub")).alias("other")).union(heads).where("other is not null and me.doc_id <> other.doc_id")
    first = first.where(may_link("me", "other")).select(F.col("me.doc_id").alias("x"), F.col("other.doc_id").alias("y")).distinct()
    named = lambda side, new: node_of.select(F.col("doc_id").alias(side), F.col("node").alias(new))
    first = first.join(named("x", "p"), "x").join(named("y", "q"), "y").where("p <> q")
    first = scratch.keep(first.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct())

    # The sets that hold each shared token. Only their nodes can be asked for.
    members = scratch.keep(
        shared.select("token", F.col("me.doc_id").alias("doc_id"), "me.n", "me.pos").join(node_of, "doc_id").groupBy("token", "node").agg(
            F.min(F.struct("pos", "n")).alias("at")
        )
    )
    scratch.release(shared)
    wanted = members.select(F.col("node").alias("doc_id")).distinct()
    packed = scratch.keep(packed_texts(documents).join(wanted, "doc_id", "left_semi"))
    scratch.release()
    roots, asked = components(verified(first, packed, ranks, scratch), scratch.keep), first
    for turn in range(HUB_ROUNDS + 1):
        placed = members.join(roots, "node", "left").select(
            "token", F.coalesce("root", "node").alias("root"), F.struct(F.col("node").alias("doc_id"), "at.n", "at.pos").alias("me")
        )
        hub = F.max_by("me", F.xxhash64("token", "me.doc_id", F.lit(turn)))
        parts = placed.groupBy("token", "root").agg(F.count("*").alias("n"), hub.alias("hub"))
        largest = parts.groupBy("token").agg(F.max(F.struct("n", "root", "hub")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
        largest = largest.select("token", F.col("top.root").alias("top"), F.col("top.hub").alias("hub"))
        open_ = placed.join(largest, "token")
        if turn < HUB_ROUNDS:
            pairs = open_.where("root <> top").select(F.col("me").alias("x"), F.col("hub").alias("y")).where(may_link("x", "y"))
        else:  # what is left, all of it
            open_ = scratch.keep(open_)
            seen = open_.join(sketch, F.col("me.doc_id") == F.col("node"), "left").withColumn("me", F.struct("me.doc_id", "me.n", "me.pos", "parity"))
            outside = seen.where("root <> top").select("token", F.col("root").alias("root_x"), F.col("me").alias("x"))
            inside = seen.select("token", F.col("root").alias("root_y"), "top", F.col("me").alias("y"))
            pairs = outside.join(inside, "token").where("root_x <> root_y and (root_y = top or x.doc_id < y.doc_id)")
            pairs = pairs.where(may_link("x", "y") & F.coalesce(may_agree("x", "y"), F.lit(True)))
        pairs = pairs.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()
        pairs = scratch.keep(pairs.join(asked, ["a", "b"], "left_anti"))
        asked = asked.union(pairs)
        scratch.release()
        if pairs.isEmpty():
            continue
        links = verified(pairs, packed, ranks, scratch)
        if not links.isEmpty():  # a component is as good as all its links
            roots = components(roots.toDF("a", "b").union(links), scratch.keep)
    scratch.release(members, packed)
    return rows, nodes, roots


def ngram_components(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text).

    component_id is the smallest doc_id reachable by links, itself included. Null and empty
    texts, and texts of blanks, have no shingles and link with nothing. Rows that share a
    doc_id are one document. A row without doc_id links with nothing and has no component.
    """
    with Scratch(documents.sparkSession, "ngram-join") as scratch:
        rows, nodes, roots = ngram_links(documents, scratch)
        classes = nodes.join(roots, "node", "left").select("n", "high", "low", "copies", F.coalesce("root", "node").alias("component_id"))
        with_set = (F.col("n") > 0) & F.col("doc_id").isNotNull()
        found = looked_up(rows.where(with_set), classes, ["n", "high", "low"], rows.count(), "copies")
        alone = rows.where(~with_set).withColumn("component_id", F.col("doc_id"))
        out = ("doc_id", F.col("n").alias("n_shingles"), "component_id")
        return stored(found.select(*out).union(alone.select(*out)), "ngram-classes")


def op9_ngram_join(spark: SparkSession, documents: DataFrame) -> DataFrame:
    return ngram_components(documents)
