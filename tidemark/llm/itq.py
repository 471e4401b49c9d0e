"""Near copies of vectors by iterative quantisation and multi-index Hamming tables.

A rotation of the principal axes is learnt, on a bounded sample, so that the signs of the
rotated coordinates are balanced bits that keep angles. The code of a vector is cut into
substrings, one hash table each: two codes that differ in fewer bits than there are
substrings agree in one of them. Vectors that meet in a bucket are compared by the cosine
of the original vectors in double precision, and a pair counts in the first table where
it meets only, so nothing is counted twice and no pairs have to be written out.

Exact copies are one vector with a weight. A bucket of more than BLOCK rows is cut into
blocks that are compared two at a time in separate tasks: all of them, no cap.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, ship_package, stored
from tidemark.llm.components import components
from tidemark.llm.vectors import common_length, matrix, usable

#: Vectors the rotation is fitted on at most; bits of a code, of that of a vector of fewer coordinates, and of a substring; rows of a block.
SAMPLE, BITS, NARROW_BITS, SUBSTRING, BLOCK = 20_000, 64, 160, 8, 1024


def learn_rotation(sample: np.ndarray, bits: int, rounds: int = 30, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): signs of ``(x - mean) @ projection`` are the code of a unit vector x.

    Iterative quantisation: fix the codes and take the rotation that best maps the data to
    them (an orthogonal Procrustes problem), then recompute the codes, and again.
    """
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    data = centred @ axes
    rotation, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((axes.shape[1], axes.shape[1])))
    for _ in range(rounds):
        codes = np.where(data @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(codes.T @ data)
        rotation = (left @ right).T
    return mean, axes @ rotation


def itq_links(vectors: DataFrame, threshold: float = 0.93, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label).

    Compared are vectors of one not-null label; null, zero and not finite vectors, and those
    of an uncommon length, have no links and are their own component. Rows that repeat a
    vector, or a whole row, count as links like any other. Rows without vec_id have no
    component and are kept.
    """
    spark = vectors.sparkSession
    base = stored(vectors.select("vec_id", "embedding", F.col("label").cast("string").alias("label")), "vectors")
    fit = base.where(usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    width = common_length(fit)
    fit = fit.where(F.size("embedding") == width)
    # One row per distinct vector of a label, named by its smallest id.
    distinct = stored(fit.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "distinct-vectors")
    rows = distinct.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("embedding").collect()
    if not rows:
        return base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    data = np.array([r["embedding"] for r in rows], np.float64)
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    # Vectors of fewer coordinates than BITS get more bits from further rotations, unlearnt, as learning would end at the same ones.
    bits, parts, made = BITS if width >= BITS else NARROW_BITS, [], 0
    while made < bits:
        mean, part = learn_rotation(data, min(width, bits - made), 0 if made else 30, seed=7 + made)
        parts.append(part)
        made += part.shape[1]
    projection = np.concatenate(parts, axis=1)
    tables = bits // SUBSTRING

    def codes(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = matrix(batch.column("embedding"), width)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        sign = (x - mean) @ projection >= 0
        return pa.record_batch(
            [*batch.columns, pa.array([r.tobytes() for r in np.packbits(sign, axis=1)], pa.binary())], names=[*batch.schema.names, "code"]
        )

    schema = f"label string, embedding {dict(base.dtypes)['embedding']}, rep long, weight long, code binary"
    coded = stored(map_batches(distinct, codes, schema), "codes")
    spread = coded.withColumn("t", F.explode(F.array([F.lit(i) for i in range(tables)])))
    spread = spread.withColumn("bucket", F.expr("substring(code, t + 1, 1)"))
    keys = ["label", "t", "bucket"]
    full = spread.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.expr(f"cast(ceil(n / {BLOCK}) as int)"))
    homes = spread.join(full, keys).withColumn("home", F.expr("cast(pmod(xxhash64(rep), blocks) as int)"))
    meets = homes.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *keys, F.least("home", "other").alias("i"), F.greatest("home", "other").alias("j"), "home", "rep", "weight", "code", "embedding"
    )
    ship_package(spark)

    def compare(group: pa.Table) -> pa.Table:
        return compare_blocks(group, width, threshold)

    found = stored(meets.groupBy(*keys, "i", "j").applyInArrow(compare, "rep long, links long, root long"), "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    per_rep = distinct.join(links, "rep", "left").join(roots, "rep", "left").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root")
    )
    inside = fit.join(per_rep, ["label", "embedding"]).select("vec_id", "n_links", F.col("root").alias("component_id"))
    part = usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("embedding") == width)
    outside = base.where(~part).select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return inside.union(outside).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def compare_blocks(group: pa.Table, width: int, threshold: float) -> pa.Table:
    """Links within a block, or between two, whose first common table this is.

    Per linked vector: the weight of what it links with, and the smallest vector it hangs
    together with here.
    """
    table, i, j = (group.column(c)[0].as_py() for c in ("t", "i", "j"))
    home = group.column("home").to_numpy()
    rep, weight = group.column("rep").to_numpy(), group.column("weight").to_numpy()
    code = np.frombuffer(b"".join(group.column("code").to_pylist()), np.uint8).reshape(len(rep), -1)
    x = matrix(group.column("embedding").combine_chunks(), width)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    left, right = np.flatnonzero(home == i), np.flatnonzero(home == j)
    a, b = np.nonzero(x[left] @ x[right].T >= threshold)
    a, b = left[a], right[b]
    if i == j:
        a, b = a[a < b], b[a < b]
    first = (code[a] == code[b]).argmax(axis=1) == table
    a, b = a[first], b[first]
    links = np.bincount(a, weight[b], len(rep)) + np.bincount(b, weight[a], len(rep))
    root = np.arange(len(rep))
    order = np.argsort(rep)
    place = np.empty_like(order)
    place[order] = root  # compare by rank, so that the smallest rep is the root
    label = place.copy()
    while True:
        old = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = np.minimum(label, label[order[label]])
        if (label == old).all():
            break
    some = np.flatnonzero(links)
    return pa.table({
        "rep": pa.array(rep[some], pa.int64()), "links": pa.array(links[some].astype(np.int64)),
        "root": pa.array(rep[order[label[some]]], pa.int64()),
    })


def op3_itq_near_copies(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    return itq_links(vectors)
