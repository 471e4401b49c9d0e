"""Best-fit packing with exact-complement hashing.

The plan is made on lengths, not on documents: a histogram of at most ``capacity``
lengths. For every gap, longest first, an index of single lengths, of sums of two and of
sums of three tells which available lengths fill it exactly; such a combination is used
as often as the counts allow. What no combination completes is packed best-fit
decreasing: into the fullest open sequence that still takes it. Each step handles all
sequences of one make-up at once, so the plan has a few thousand lines whatever the
number of documents, and the driver holds lengths only.

Documents meet their places by rank: the i-th piece of a length goes to the i-th place
the plan has for that length. Ranks come from counts per partition, never from one task
that sees all pieces of a length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, stored, texts
from tidemark.llm.tokens import encoder

CAPACITY = 1024
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(documents: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ids with ``end_id`` behind; longer ones are cut, the first piece may be shorter."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode, tail, out = encoder(tokenizer).encode, int(end_id).to_bytes(2, "little"), []
        for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
            raw = np.frombuffer(encode(text) + tail, "<u2").astype("<u4").tobytes()
            count = len(raw) // 4
            first = count % capacity or capacity
            bounds = [0, *range(first, count + 1, capacity)]
            out += [(doc, k, a, b - a, zlib.crc32(raw[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
        return pa.record_batch([pa.array(c) for c in zip(*out)], names=["doc_id", "piece", "start", "length", "ids_crc32"]).cast(
            pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
        )

    return map_batches(documents.select("doc_id", "text"), work, PIECES)


def complements(gap: int, counts: list[int], pairs: dict[int, list[tuple[int, int]]]) -> tuple[int, ...] | None:
    """Available lengths that add up to ``gap`` exactly: one, else two, else three; the longest first."""
    if counts[gap]:
        return (gap,)
    for a, b in pairs.get(gap, ()):
        if counts[a] and counts[b] and (a != b or counts[a] > 1):
            return (a, b)
    there = [x for x in range(1, gap) if counts[x]]
    mask, sums = sum(1 << x for x in there), 0
    for x in there:
        sums |= mask << x
    for c in reversed(there):
        if not sums >> (gap - c) & 1:
            continue
        for a, b in pairs.get(gap - c, ()):
            if a <= c and all(counts[x] >= n for x, n in Counter((a, b, c)).items()):
                return (c, a, b)
    return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Make-ups (lengths in a sequence) and how many sequences have them."""
    counts = [0] * (capacity + 1)
    for length, count in histogram.items():
        counts[length] = count
    present = [x for x, n in enumerate(counts) if n]
    pairs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i in range(len(present) - 1, -1, -1):
        for b in present[: i + 1]:
            if present[i] + b <= capacity:
                pairs[present[i] + b].append((present[i], b))
    made: list[tuple[tuple[int, ...], int]] = []
    if counts[capacity]:
        made.append(((capacity,), counts[capacity]))
        counts[capacity] = 0
    for length in range(capacity - 1, 0, -1):
        while counts[length]:
            counts[length] -= 1  # the piece whose gap is filled
            rest = complements(capacity - length, counts, pairs)
            counts[length] += 1
            if rest is None:
                break
            need = Counter((length, *rest))
            times = min(counts[x] // n for x, n in need.items())
            for x, n in need.items():
                counts[x] -= n * times
            made.append(((length, *rest), times))
    return made + best_fit(counts, capacity)


def best_fit(counts: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: sequences of one make-up move together."""
    open_: dict[int, list[list]] = defaultdict(list)  # by gap: [make-up, how many]
    gaps: list[int] = []
    closed: list[tuple[tuple[int, ...], int]] = []

    def put(lengths: tuple[int, ...], many: int, gap: int) -> None:
        if not gap:
            closed.append((lengths, many))
            return
        if not open_[gap]:
            gaps.insert(bisect_left(gaps, gap), gap)
        open_[gap].append([lengths, many])

    for length in range(capacity, 0, -1):
        left = counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                if left >= each:
                    put((length,) * each, left // each, capacity - each * length)
                    left %= each
                if left:
                    put((length,) * left, 1, capacity - left * length)
                break
            gap = gaps[at]
            makeup = open_[gap][-1]
            take = min(left, makeup[1])
            makeup[1] -= take
            if not makeup[1]:
                open_[gap].pop()
                if not open_[gap]:
                    gaps.pop(at)
            put((*makeup[0], length), take, gap - length)
            left -= take
    return closed + [(m, n) for group in open_.values() for m, n in group]


def places(made: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank + 1, sequence of the first rank, offset) of each slot of the plan."""
    taken: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for lengths, many in made:
        offset = 0
        for length in lengths:
            out.append((length, taken[length], taken[length] + many, sequence, offset))
            taken[length] += many
            offset += length
        sequence += many
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to stored rows that have ``length`` (1 to capacity).

    The plan is broadcast: at most a few times ``capacity`` lines, as every line but the
    last of a length uses up a length or a make-up.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = places(plan(histogram, capacity))
    by_length: dict[int, list] = defaultdict(list)
    for length, first, last, sequence, offset in slots:
        by_length[length].append((first, last, sequence, offset))
    table = {k: np.array(sorted(v), np.int64) for k, v in by_length.items()}

    # Ranks within a length: hash slices of it, the slices' counts summed, a rank in each slice.
    slices = F.pmod(F.xxhash64(*[c for c in ("doc_id", "piece") if c in pieces.columns]), F.lit(_slices(histogram)))
    sliced = stored(pieces.withColumn("_slice", slices), "pieces-sliced")
    sizes = sliced.groupBy("length", "_slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "_slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("length", "_slice").orderBy(*[c for c in ("doc_id", "piece") if c in pieces.columns])
    ranked = (
        sliced.withColumn("_row", F.row_number().over(within) - 1)
        .join(firsts, ["length", "_slice"])
        .withColumn("_rank", F.col("_first") + F.col("_row"))
        .drop("_slice", "_row", "_first")
    )
    columns = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        length = batch.column("length").to_numpy(zero_copy_only=False)
        rank = batch.column("_rank").to_numpy(zero_copy_only=False)
        sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        for value in np.unique(length):
            rows, lines = np.flatnonzero(length == value), table[int(value)]
            line = lines[np.searchsorted(lines[:, 0], rank[rows], side="right") - 1]
            sequence[rows] = line[:, 2] + rank[rows] - line[:, 0]
            offset[rows] = line[:, 3]
        return pa.record_batch(
            [batch.column(c) for c in columns] + [pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"]
        )

    return map_batches(ranked.select(*columns, "_rank"), work, f"{schema}, sequence_id long, offset long")


#: Rows of one length that one task ranks.
SLICE_ROWS = 20_000


def _slices(histogram: dict[int, int]) -> int:
    """So many slices that the commonest length has about SLICE_ROWS rows in each."""
    return max(1, -(-max(histogram.values(), default=1) // SLICE_ROWS))


def op10_packing(spark: SparkSession, documents: DataFrame, tokenizer: str) -> DataFrame:
    return pack(stored(token_pieces(documents, tokenizer, 2), "pieces"))
