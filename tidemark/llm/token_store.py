"""Token ids as files: frequency-ranked ids in byte-aligned variable-length coding.

Ids are counted over the whole corpus and replaced by their rank, so that frequent ids
are small. Four ranks share a control byte (two bits each: the number of bytes less one)
and the data bytes follow separately, little-endian. A decoder looks the control byte up
in a table of the four lengths and gathers the bytes with numpy; it never branches by id.

A file is a row of blocks in ascending ``doc_id`` order; files are in order of the numbers in
their names (task, then file of the task).

    block  magic "TMK1", documents u32, ids u32, control bytes u32, data bytes u32,
           per document: doc_id i64, has_id u8, ids u32 (three arrays),
           control bytes, data bytes, crc32 of all before u32
           and one line feed, which Spark's text writer puts after every record

``ranks`` holds the id of every rank as u32. Blocks are written and committed by Spark's
own file writer, so a lost executor leaves no half file behind.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shared_path, ship_package, small, stored, texts
from tidemark.llm.tokens import encoder

MAGIC = b"TMK1"
#: Ids per block, blocks per file, ids per partition: a file stays near 25 MB.
BLOCK_IDS, FILE_BLOCKS, PART_IDS = 1 << 18, 64, 1 << 23
#: Bytes of each of the four ids, by control byte.
LENGTHS = np.stack([(np.arange(256) >> shift & 3) + 1 for shift in (0, 2, 4, 6)], axis=1).astype(np.int64)


def encode_ids(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of a row of ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    size = np.ones(len(ranks), np.int64)
    longer = [np.flatnonzero(ranks >> np.uint32(8 * k)) for k in (1, 2, 3)]
    for more in longer:
        size[more] += 1
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    start = np.cumsum(size) - size
    data = np.empty(int(size.sum()), np.uint8)
    data[start] = ranks & np.uint32(0xFF)
    for k, more in enumerate(longer, 1):
        data[start[more] + k] = ranks[more] >> np.uint32(8 * k) & np.uint32(0xFF)
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_ids(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ranks again, through the table of lengths."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    start = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = raw[start].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if not len(more):
            break
        ranks[more] |= raw[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def pack_block(doc_ids: list[int | None], counts: list[int], ranks: np.ndarray) -> bytes:
    control, data = encode_ids(ranks)
    head = np.array([len(doc_ids), len(ranks), len(control), len(data)], "<u4").tobytes()
    body = b"".join([
        MAGIC, head, np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
        np.array(counts, "<u4").tobytes(), control, data,
    ])
    return body + zlib.crc32(body).to_bytes(4, "little")


def unpack_blocks(content: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(doc_ids, counts, ranks) of each block of a file."""
    at = 0
    while at < len(content):
        if content[at : at + 4] != MAGIC:
            raise ValueError(f"no block at byte {at}")
        docs, ids, control, data = np.frombuffer(content, "<u4", 4, at + 4).tolist()
        p = at + 20
        names = np.frombuffer(content, "<i8", docs, p)
        known = np.frombuffer(content, np.uint8, docs, p := p + 8 * docs)
        counts = np.frombuffer(content, "<u4", docs, p := p + docs)
        p += 4 * docs
        end = p + control + data
        if zlib.crc32(content[at:end]) != int.from_bytes(content[end : end + 4], "little"):
            raise ValueError(f"damaged block at byte {at}")
        yield (
            [int(n) if k else None for n, k in zip(names, known)], counts.astype(np.int64),
            decode_ids(content[p : p + control], content[p + control : end], ids),
        )
        at = end + 5


def tokenised(documents: DataFrame, tokenizer: str, end_id: int | None) -> tuple[DataFrame, np.ndarray]:
    """Stored (doc_id, n_tokens, ids): 16-bit ids, compressed; and how often each id occurs. A null text is empty.

    Ids are counted as they are made: a task ends with a row of its counts (n_tokens = -1). The
    driver gets one row per id of the vocabulary at most.
    """
    import zstandard

    tail = b"" if end_id is None else int(end_id).to_bytes(2, "little")
    vocabulary = encoder(tokenizer).size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, press = encoder(tokenizer).encode, zstandard.ZstdCompressor(level=1).compress
        seen = np.zeros(vocabulary, np.int64)

        def out(docs: pa.Array, counts: list[int], values: list[bytes]) -> pa.RecordBatch:
            return pa.record_batch({"doc_id": docs, "n_tokens": pa.array(counts, pa.int64()), "ids": pa.array(values, pa.binary())})

        for batch in small(batches):
            ids = [encode(t) + tail for t in texts(batch)]
            seen += np.bincount(np.frombuffer(b"".join(ids), "<u2"), minlength=vocabulary)
            planes = (np.frombuffer(x, np.uint8).reshape(-1, 2).T.tobytes() for x in ids)
            yield out(batch.column("doc_id"), [len(x) // 2 for x in ids], [press(x) for x in planes])
        yield out(pa.array([None], pa.int64()), [-1], [press(seen.astype("<u8").tobytes())])

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, seen = zstandard.ZstdDecompressor().decompress, np.zeros(vocabulary, np.int64)
        for batch in batches:
            for value in batch.column("ids").to_pylist():
                seen += np.frombuffer(unpack(value), "<u8").astype(np.int64)
        some = np.flatnonzero(seen)
        yield pa.record_batch({"id": pa.array(some, pa.int64()), "n": pa.array(seen[some], pa.int64())})

    ship_package(documents.sparkSession)
    rows = stored(documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary"), "token-ids")
    total = np.zeros(vocabulary, np.int64)
    for row in rows.where("n_tokens = -1").mapInArrow(counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        total[row["id"]] = row["n"]
    return rows.where("n_tokens >= 0"), total


def unpressed(values: list[bytes], counts: list[int]) -> Iterator[np.ndarray]:
    """The ids of each value again."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for value, count in zip(values, counts):
        raw = np.frombuffer(unpack(value, max_output_size=max(1, 2 * count)), np.uint8)
        yield raw[:count] | raw[count:].astype("<u2") << 8


def write_store(documents: DataFrame, tokenizer: str, end_id: int | None, path: str) -> None:
    """Encode every whole text of ``documents`` (doc_id, text) into files below ``path``.

    Null texts are empty; documents without doc_id come first; rows that share a doc_id
    stand side by side, in order of their ids. An empty table writes no block. Files are in order
    of the numbers in their names.
    """
    spark = documents.sparkSession
    ship_package(spark)
    vocabulary = encoder(tokenizer).size
    tokens, seen = tokenised(documents, tokenizer, end_id)
    # The id of every rank: most frequent first, ties to the smaller id.
    order = np.argsort(-seen, kind="stable").astype("<u4")
    rank_of = np.empty(vocabulary, "<u4")
    rank_of[order] = np.arange(vocabulary)
    total = int(seen.sum())

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, counts, parts, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            block = pack_block(docs, counts, np.concatenate(parts))
            return pa.record_batch({"block": pa.array([block], pa.binary())})

        for batch in batches:
            names, sizes, values = (batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids"))
            for doc, count, ids in zip(names, sizes, unpressed(values, sizes)):
                docs.append(doc)
                counts.append(count)
                parts.append(rank_of[ids])
                held += count
                if held >= BLOCK_IDS:
                    yield out()
                    docs, counts, parts, held = [], [], [], 0
        if docs:
            yield out()

    (
        tokens.repartitionByRange(max(1, -(-total // PART_IDS)), "doc_id", F.hash("ids"))
        .sortWithinPartitions("doc_id", "ids")
        .mapInArrow(blocks, "block binary")
        .select(F.col("block").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", FILE_BLOCKS).text(f"{path}/blocks")
    )
    ranks = spark.createDataFrame([(bytearray(order.tobytes()),)], "ranks binary")
    ranks.coalesce(1).select(F.col("ranks").cast("string").alias("value")).write.text(f"{path}/ranks")


def read_ranks(spark: SparkSession, path: str) -> np.ndarray:
    content = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ranks").first()["content"]
    return np.frombuffer(content[:-1], "<u4")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, file, place, n_tokens, ids): every document's ids, decoded from the files."""
    order = read_ranks(spark, path)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
            place = 0
            for docs, counts, ranks in unpack_blocks(content):
                ids = order[ranks]
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                yield pa.record_batch({
                    "doc_id": pa.array(docs, pa.int64()), "file": pa.array([name] * len(docs)),
                    "place": pa.array(np.arange(place, place + len(docs)), pa.int64()),
                    "n_tokens": pa.array(counts), "ids": values,
                })
                place += len(docs)

    return _flat(_files(spark, path), work, "doc_id long, file string, place long, n_tokens long, ids array<int>")


def digest_store(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), read from the files.

    ``start`` needs the totals of the files before: one small row per file, summed in
    the order of their names.
    """
    order = read_ranks(spark, path)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
            before = 0
            for docs, counts, ranks in unpack_blocks(content):
                raw = memoryview(order[ranks].astype("<u4").tobytes())
                ends = np.cumsum(counts)
                sums = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for c, e in zip(counts.tolist(), ends.tolist())]
                yield pa.record_batch({
                    "doc_id": pa.array(docs, pa.int64()), "file": pa.array([name] * len(docs)),
                    "before": pa.array(before + ends - counts), "n_tokens": pa.array(counts),
                    "ids_crc32": pa.array(sums, pa.int64()),
                })
                before += int(ends[-1])

    rows = stored(
        _flat(_files(spark, path), work, "doc_id long, file string, before long, n_tokens long, ids_crc32 long"), "token-rows"
    )
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    # By the numbers in the name (task, file of the task): they outgrow their digits.
    numbers = [F.regexp_extract("file", pattern, 1).cast("long") for pattern in (r"part-(\d+)-", r"-c(\d+)\.[a-z]+$")]
    earlier = Window.orderBy(*numbers).rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("first"))
    return rows.join(starts, "file").select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/blocks").select("path", "content")


def _flat(df: DataFrame, work, schema: str) -> DataFrame:
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from work(batch)

    return df.mapInArrow(run, schema)


def op1_token_store(spark: SparkSession, documents: DataFrame, tokenizer: str) -> DataFrame:
    path = shared_path(spark, "token-store")
    write_store(documents, tokenizer, 2, path)
    return digest_store(spark, path)
