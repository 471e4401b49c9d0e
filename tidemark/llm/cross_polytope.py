"""Nearest neighbours by inner product with cross-polytope hashing.

A fast pseudo-rotation (three rounds of random signs and a Hadamard transform) turns a
vector, and its hash is the nearest signed axis: the largest coordinate and its sign.
Each table has a rotation of its own. A query probes, in every table, the signed axes its
rotated coordinates rank highest; what lies in those buckets is scored exactly with the
original vectors in double precision, bucket by bucket, and only the best of each task
leave it. A bucket of more than BLOCK vectors is cut into blocks; a query goes to all of
them, so nothing is capped.

Directions are hashed, as a bucket can tell angles only. A long vector reaches a large inner
product at a wide angle, so vectors longer than LONGER times the median take no hash: every
query meets them all, in blocks. A query that found fewer than it should is compared with
every vector. Tables of any size go the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ship_package, stored
from tidemark.llm.vectors import common_length, matrix, usable

TABLES, PROBES, BLOCK, SEED = 8, 16, 16_384, 11
#: Coordinates for which PROBES holds (more have as many more); length over the median that takes no hash.
PROBED_SIZE, LONGER = 64, 1.05


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, step = x.shape[1], 1
    while step < n:
        y = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


class Rotations:
    """The pseudo-rotations of all tables."""

    def __init__(self, width: int, tables: int = TABLES, seed: int = SEED):
        self.size = 1 << max(1, int(np.ceil(np.log2(width))))
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, 3, self.size))

    def turned(self, x: np.ndarray) -> Iterator[np.ndarray]:
        padded = np.zeros((len(x), self.size))
        padded[:, : x.shape[1]] = x
        for rounds in self.signs:
            y = padded
            for signs in rounds:
                y = hadamard(y * signs)
            yield y

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """Nearest signed axis of each row in each table."""
        out = []
        for y in self.turned(x):
            axis = np.abs(y).argmax(axis=1)
            out.append(2 * axis + (y[np.arange(len(y)), axis] < 0))
        return np.stack(out, axis=1)

    def probes(self, x: np.ndarray, many: int) -> np.ndarray:
        """The ``many`` signed axes each row is nearest to, in each table."""
        out = []
        for y in self.turned(x):
            both = np.stack([y, -y], axis=2).reshape(len(y), -1)
            out.append(np.argsort(-both, axis=1, kind="stable")[:, :many])
        return np.stack(out, axis=1)


class Best:
    """The best ``k`` of every query so far: larger score first, ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    def offer(self, queries: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        scores = q @ x.T
        for query, vector, row in zip(queries.tolist(), q, scores):
            near = np.arange(len(ids))
            if len(ids) > self.k + 1:  # the query itself may be among them
                edge = np.partition(row, -self.k - 1)[-self.k - 1]
                near = np.flatnonzero(row >= edge - 1e-9 * (1 + abs(edge)))
            near = near[ids[near] != query]
            # Scored again the same way for every row, so that equal vectors tie exactly.
            exact = (x[near] * vector).sum(axis=1)
            old = self.held.get(query)
            i, s = ids[near], exact
            if old is not None:
                i, s = np.append(old[0], i), np.append(old[1], s)
                i, first = np.unique(i, return_index=True)
                s = s[first]
            order = np.lexsort((i, -s))[: self.k]
            self.held[query] = i[order], s[order]

    def batches(self, rows: int = 2000) -> Iterator[pa.RecordBatch]:
        held = list(self.held.items())
        for at in range(0, len(held), rows):
            part = held[at : at + rows]
            yield pa.record_batch({
                "query_id": pa.array(np.repeat([k for k, _ in part], [len(v[0]) for _, v in part]), pa.int64()),
                "vec_id": pa.array(np.concatenate([v[0] for _, v in part]), pa.int64()),
                "score": pa.array(np.concatenate([v[1] for _, v in part]), pa.float64()),
            })


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id divisible by ``every`` its ``k`` best others found.

    Null, zero and not finite vectors, those of an uncommon length and rows without vec_id
    take no part. Rows that repeat a vec_id count once (the smallest vector stays). Only if
    there are fewer than ``k`` others does a query get fewer rows.
    """
    spark = vectors.sparkSession
    base = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & usable("embedding"))
    base = stored(base.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "search-vectors")
    width = common_length(base)
    base = base.where(F.size("embedding") == width)
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    total, median = base.agg(F.count("*"), F.percentile_approx(length, 0.5)).first()
    hashes = length <= F.lit(LONGER * (median or 0.0))
    turn = Rotations(max(width, 1), tables)
    many = -(-probes * max(turn.size, PROBED_SIZE) // PROBED_SIZE)
    kind = dict(base.dtypes)["embedding"]
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    everything = F.lit(-1).alias("key")  # the key without a hash

    def hashed(df: DataFrame, query: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = matrix(batch.column("embedding"), width)
                    got = turn.probes(x, many) if query else turn.buckets(x)[:, :, None]
                    keys = (np.arange(tables)[None, :, None] * 2 * turn.size + got).reshape(len(x), -1)
                    yield pa.record_batch([*batch.columns, pa.array(list(keys.astype(np.int32)), pa.list_(pa.int32()))], names=["vec_id", "embedding", "keys"])

        ship_package(spark)
        return df.mapInArrow(run, f"vec_id long, embedding {kind}, keys array<int>").select("vec_id", "embedding", F.explode("keys").alias("key"))

    def met(members: DataFrame, queries: DataFrame) -> DataFrame:
        """(query_id, vec_id, score): the best of each task, of the members and queries (vec_id, embedding, key) of one key."""
        # At most tables * 2 * size counts and one more, however many vectors there are.
        counts = {r["key"]: r["n"] for r in members.groupBy("key").agg(F.count("*").alias("n")).collect()}
        cut = [F.lit(x) for key, n in counts.items() if n > BLOCK for x in (key, -(-n // BLOCK))]
        blocks = F.coalesce(F.create_map(*cut)[F.col("key")], F.lit(1)) if cut else F.lit(1)
        members = members.select("key", F.pmod(F.xxhash64("vec_id"), blocks).cast("int").alias("block"), F.lit(False).alias("query"), "vec_id", "embedding")
        queries = queries.select("key", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))).alias("block"), F.lit(True).alias("query"), "vec_id", "embedding")
        dealt = members.union(queries).repartition("key", "block").sortWithinPartitions("key", "block", "query")
        return dealt.mapInArrow(search, "query_id long, vec_id long, score double")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, now, ids, rows = Best(k), None, [], []
        x = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy().astype(np.int64) << 32 | batch.column("block").to_numpy().astype(np.int64)
            query = batch.column("query").to_numpy(zero_copy_only=False)
            vec, data = batch.column("vec_id").to_numpy(), matrix(batch.column("embedding"), width)
            cut = np.flatnonzero((key[1:] != key[:-1]) | (query[1:] != query[:-1])) + 1
            for a, b in zip([0, *cut], [*cut, len(key)]):
                if key[a] != now:
                    now, ids, rows, x = key[a], [], [], None
                if not query[a]:
                    ids.append(vec[a:b])
                    rows.append(data[a:b])
                elif ids:
                    if x is None:
                        ids, x = [np.concatenate(ids)], np.concatenate(rows)
                    for at in range(a, b, 256):
                        end = min(b, at + 256)
                        best.offer(vec[at:end], data[at:end], ids[0], x)
        yield from best.batches()

    def top(found: DataFrame) -> DataFrame:
        best = F.slice(F.sort_array(F.collect_set(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
        return found.groupBy("query_id").agg(best.alias("best"))

    asking = base.where(is_query)
    whole, whole_queries = base.select("vec_id", "embedding", everything), asking.select("vec_id", "embedding", everything)
    members = hashed(base.where(hashes), query=False).union(whole.where(~hashes))
    best = stored(top(met(members, hashed(asking, query=True).union(whole_queries))), "search-best")
    enough = best.where(F.size("best") >= min(k, total - 1))
    short = stored(whole_queries.join(enough, F.col("vec_id") == F.col("query_id"), "left_anti"), "search-short")
    if not short.isEmpty():
        best = enough.union(top(met(whole, short)))
    return best.select("query_id", F.posexplode("best").alias("p", "b")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score")
    )


def op4_cross_polytope(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    return nearest(vectors)
