"""Near-duplicate vectors by iterative quantisation.

A rotation is learned that makes the signs of the rotated vectors balanced bits
with little loss. Further rotations give further bits. The code is cut into
pieces, each the key of one hash table; vectors that agree in a piece are
compared: first by the Hamming distance of the codes, then by the cosine of the
original vectors in double precision.

Rows of one key are handled together, in blocks of bounded size; a key with more
rows than a block is dealt into pairs of blocks. Codes alone are dealt first; only
rows with a near code opposite, in the first table where the two meet, are followed
by their vectors. Of a block pair only counts and a spanning set of links come back,
never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitwx.llm.blocks import groups, in_block_pairs, roots
from transitwx.llm.graph import components
from transitwx.session import stage

THRESHOLD = 0.9
#: Vectors that the rotations are learned from at most.
SAMPLE = 20_000
#: Wanted share of pairs at the threshold that meet in some table, measured on pairs
#: made from the sample, and the most tables for it.
RECALL, MOST_TABLES, MADE = 0.98, 512, 4000
#: Rows of a table's key by expectation, for vectors without structure.
PER_KEY = 16
BLOCK = 1024
ITERATIONS = 30
SEED = 11
#: Codes further apart than this many standard deviations beyond the mean of such
#: pairs are not compared.
SLACK = 6.0
#: The length of a vector stands above the bits of its key.
LENGTH_SHIFT = 32


@dataclass
class Codes:
    """Learned rotations; bit i of a vector is the sign of its i-th product."""

    mean: np.ndarray
    rotations: np.ndarray  # dimensions x bits
    piece_bits: int
    tables: int

    def bits(self, x: np.ndarray) -> np.ndarray:
        """0/1 codes of unit vectors."""
        return ((x - self.mean) @ self.rotations > 0).astype(np.uint8)

    def keys(self, bits: np.ndarray) -> np.ndarray:
        """The pieces of the codes as integers, one column per table."""
        pieces = bits[:, : self.tables * self.piece_bits].reshape(len(bits), self.tables, self.piece_bits)
        return pieces.astype(np.int64) @ (1 << np.arange(self.piece_bits, dtype=np.int64))


def learn(x: np.ndarray, piece_bits: int, tables: int) -> Codes:
    """Iterative quantisation of unit vectors: in turn the nearest corners of the
    cube for a rotation, and the best rotation for the corners (Procrustes)."""
    mean = x.mean(axis=0)
    z = x - mean
    # principal directions, in which the rotations are learned
    _, axes = np.linalg.eigh(z.T @ z)
    z = z @ axes
    rng = np.random.default_rng(SEED)
    d, parts = x.shape[1], []
    while sum(p.shape[1] for p in parts) < piece_bits * tables:
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(ITERATIONS):
            u, _, v = np.linalg.svd(np.sign(z @ r).T @ z)
            r = (u @ v).T
        parts.append(axes @ r)
    # pieces take bits of all rotations in turn
    return Codes(mean, np.concatenate(parts, axis=1), piece_bits, tables)


def pairs_at(x: np.ndarray, threshold: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit vectors of a sample, each with one at the threshold's angle from it: once
    in any direction, once in the direction of another vector of the sample."""
    rng = np.random.default_rng(SEED)
    x = x[rng.integers(0, len(x), MADE)]
    out = []
    for towards in (rng.normal(size=x.shape), x[rng.permutation(len(x))] + 1e-3 * rng.normal(size=x.shape)):
        side = towards - (towards * x).sum(axis=1, keepdims=True) * x
        side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-300)
        out.append((x, threshold * x + math.sqrt(1 - threshold**2) * side))
    return out


def plan(x: np.ndarray, rows: int, threshold: float) -> tuple[Codes, float]:
    """Codes with as many tables as it takes for RECALL of pairs at the threshold to
    meet, and how many bits of near codes differ at most. Keys have about PER_KEY
    rows where vectors have no structure."""
    bits = min(LENGTH_SHIFT - 2, max(4, math.ceil(math.log2(rows / PER_KEY)) if rows > PER_KEY else 4))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    tables = max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - same)))
    made = pairs_at(x, threshold)
    while True:
        codes = learn(x, bits, tables)
        pairs = [(codes.bits(a), codes.bits(b)) for a, b in made]
        met = min(float((codes.keys(a) == codes.keys(b)).any(axis=1).mean()) for a, b in pairs)
        if met >= RECALL or tables >= MOST_TABLES:
            break
        tables = min(MOST_TABLES, math.ceil(tables * 1.4))
    apart = [(a != b).sum(axis=1) for a, b in pairs]
    return codes, max(float(n.mean() + SLACK * n.std()) for n in apart)


def unit(column: pa.Array, width: int) -> np.ndarray:
    """Unit vectors; a vector shorter than ``width`` ends in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    x = np.zeros((len(column), width))
    x[np.arange(width)[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    # scaled first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def entries(batches: Iterator[pa.RecordBatch], codes: Codes, width: int) -> Iterator[pa.RecordBatch]:
    """``id, code, keys``: the packed bits, and the vector's key in every table."""
    for batch in batches:
        if len(batch):
            column = batch.column("v")
            bits = codes.bits(unit(column, width))
            keys = codes.keys(bits) + (np.diff(column.offsets.to_numpy()).astype(np.int64) << LENGTH_SHIFT)[:, None]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * keys.shape[1], pa.int32()), pa.array(keys.reshape(-1)))
            packed = [row.tobytes() for row in np.packbits(bits, axis=1)]
            yield pa.record_batch([batch.column("id"), pa.array(packed, pa.binary()), lists], names=["id", "code", "keys"])


def near_codes(bits: np.ndarray, codes: Codes, first: np.ndarray, second: np.ndarray, table: int, far: float) -> np.ndarray:
    """Which rows of two blocks have near codes and share no earlier table."""
    signs = bits.astype(np.float32) * 2 - 1
    near = signs[first] @ signs[second].T >= bits.shape[1] - 2 * far
    keys = codes.keys(bits)
    for t in range(table):
        near &= keys[first, t][:, None] != keys[second, t][None, :]
    return near


def sides(g: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows of both blocks of a pair, and whether it is one block."""
    low, high = (g.column(n)[0].as_py() for n in ("low", "high"))
    block = g.column("block").to_numpy(zero_copy_only=False)
    first = np.flatnonzero(block == low)
    return first, first if low == high else np.flatnonzero(block == high), low == high


def sift(batches: Iterator[pa.RecordBatch], codes: Codes, far: float) -> Iterator[pa.RecordBatch]:
    """The rows of a block pair with a near code opposite."""
    total = codes.rotations.shape[1]
    for g in groups(batches, ["table", "key", "low", "high"]):
        first, second, one = sides(g)
        packed = np.frombuffer(b"".join(g.column("code").to_pylist()), np.uint8).reshape(len(g), -1)
        near = near_codes(np.unpackbits(packed, axis=1)[:, :total], codes, first, second, g.column("table")[0].as_py(), far)
        if one:
            np.fill_diagonal(near, False)
        keep = np.zeros(len(g), bool)
        keep[first] |= near.any(axis=1)
        keep[second] |= near.any(axis=0)
        if keep.any():
            yield g.drop_columns(["code"]).filter(pa.array(keep))


FOUND = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def compare(batches: Iterator[pa.RecordBatch], codes: Codes, threshold: float, far: float, width: int) -> Iterator[pa.RecordBatch]:
    """For every row of a block pair the weight of its new links, and the smallest
    id it reaches inside the block pair. A pair counts in the first table where
    it meets."""
    for g in groups(batches, ["table", "key", "low", "high"]):
        if len(g) < 2:
            continue
        ids, weight = (g.column(n).to_numpy(zero_copy_only=False) for n in ("id", "copies"))
        x = unit(g.column("v"), width)
        first, second, one = sides(g)
        linked = near_codes(codes.bits(x), codes, first, second, g.column("table")[0].as_py(), far)
        linked &= x[first] @ x[second].T >= threshold
        if one:
            np.fill_diagonal(linked, False)
        if not linked.any():
            continue
        label = roots(ids, first, second, linked)
        links = np.zeros(len(ids), np.int64)
        links[first] += linked @ weight[second]
        if not one:
            links[second] += weight[first] @ linked
        keep = links > 0
        yield pa.record_batch([ids[keep], links[keep], label[keep]], schema=FOUND)


def usable(column: str):
    v = F.col(column)
    magnitude = F.aggregate(v, F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x.cast("double"))))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & (magnitude > 0)


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Two vectors are linked if their cosine is ``threshold`` or more and they meet
    in a table (about RECALL of pairs right at the threshold do, of closer ones
    nearly all; the number of tables is found by measuring that). Vectors of
    different lengths are never linked. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable and ``kept`` whether it is the
    row's own.

    Null and zero vectors and those with null or non-finite components or without
    an id are linked with nothing (a null
    id has a null component and is kept). Rows with equal vectors are compared
    once and counted as often as they occur; repeated ids count as rows of their
    own. An empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    fit = stage(rows.where(usable("v") & F.col("vec_id").isNotNull()), "vectors")
    width = fit.agg(F.max(F.size("v"))).first()[0] or 0
    # -0.0 and 0.0 are one value
    plain = F.transform("v", lambda x: x.cast("double") + F.lit(0.0)).alias("v")
    copies = stage(fit.select("vec_id", plain).groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "copies")
    n = copies.count()
    members = fit.select("vec_id", plain).join(copies.withColumnRenamed("id", "rep"), "v").select("vec_id", "rep", "copies")
    if n == 0:
        found = None
    else:
        drawn = copies.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(sample).select("v").toArrow()
        codes, far = plan(unit(drawn.column("v").combine_chunks(), width), n, threshold)
        # each task gets the rotations once: width x bits numbers
        shared = vectors.sparkSession.sparkContext.broadcast(codes)
        keyed = copies.select("id", "v").mapInArrow(
            lambda b: entries(b, shared.value, width), "id long, code binary, keys array<long>"
        )
        keyed = stage(keyed, "keys")
        spread = keyed.select("id", "code", F.posexplode("keys").alias("table", "key"))
        order = ["table", "key", "low", "high"]
        partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))

        def together(rows: DataFrame) -> DataFrame:
            return rows.repartition(partitions, *order).sortWithinPartitions(*order)

        pairs = together(in_block_pairs(spread, ["table", "key"], BLOCK).select(*order, "block", "id", "code"))
        near = pairs.mapInArrow(lambda b: sift(b, shared.value, far), pairs.drop("code").schema)
        work = together(stage(near, "near").join(copies, "id"))
        found = stage(
            work.select(*order, "block", "id", "copies", "v").mapInArrow(
                lambda b: compare(b, shared.value, threshold, far, width), "id long, links long, root long"
            ),
            "found",
        )
    if found is None:
        links = members.select(F.col("rep").alias("id"), F.lit(0).cast("long").alias("links")).limit(0)
        grouped = members.select(F.col("rep").alias("id"), F.col("rep").alias("component_id")).limit(0)
    else:
        links = found.groupBy("id").agg(F.sum("links").alias("links"))
        grouped = components(found.select("id", "root"))
    per_rep = copies.select("id", "copies").join(links, "id", "left").join(grouped, "id", "left")
    per_row = members.drop("copies").join(per_rep, F.col("rep") == F.col("id")).select(
        F.col("vec_id").alias("row_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"),
    )
    # what is linked with nothing stands for itself
    lonely = rows.where(~F.coalesce(usable("v") & F.col("vec_id").isNotNull(), F.lit(False)))
    alone = lonely.select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    out = per_row.union(alone).toDF("vec_id", "n_links", "component_id")
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
