"""Near-duplicate documents by DartMinHash on word shingles.

Every element of a weighted set owns the strip ``[0, weight) x [0, inf)`` of
(weight, rank). Darts are thrown into the plane at places that depend on the
element alone; a dart that lands within the weight belongs to the set. Each dart
names one of K coordinates, and the dart of lowest rank in a coordinate is the
signature there. Two sets agree in a coordinate with the probability of their
weighted Jaccard similarity. A set of total weight W needs ranks up to about
``(K ln K + 2 K) / W`` only: a long text throws about one dart per shingle, a
short one some K ln K, instead of K hashes for every shingle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitwx.llm.bits import in_bits
from transitwx.llm.blocks import groups, in_block_pairs, roots
from transitwx.llm.graph import components
from transitwx.llm.tokens import folded_table, mix, slices, valid_windows, windows, words_of
from transitwx.session import stage

SHINGLE = 5
THRESHOLD = 0.8
#: 32 bands of 4 coordinates: a pair of similarity 0.8 is missed with 5e-8.
BANDS, BAND_ROWS = 32, 4
COORDINATES = BANDS * BAND_ROWS
#: Ranks are cut into [0, 1), [1, 2), [2, 4), [4, 8), ...
NO_ID = (1 << 63) - 1
#: Rows of a bucket that are compared at once, and entries of the matrix for it.
BLOCK, MATRIX = 2048, 1 << 23
#: Shingles of a block: long texts make blocks of fewer rows.
BLOCK_SHINGLES = 1 << 21
#: Of every coordinate so many bits are kept to sort out candidates before their
#: shingles are looked at; a pair at the threshold is lost with at most this.
CODE_BITS, LOST = 2, 1e-7
#: A cell of mean 1 or less holds more darts than this with less than 1e-16.
MOST_DARTS = 20


def shingles(part: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, count) of all rows of a slice, sorted by row and hash.

    A text with fewer than ``size`` words, but one at least, is one shingle.
    """
    words = words_of(part, folded_table())
    counts = np.diff(words.first)
    ok = valid_windows(words, size)
    rows, keys = words.row[: len(ok)][ok], windows(words, size)[ok]
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        own = [windows(_part(words, i), int(counts[i]))[0] for i in few]
        rows, keys = np.append(rows, few), np.append(keys, np.array(own, np.uint64))
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    if not len(rows):
        return rows, keys, np.zeros(0, np.int64)
    new = np.append(True, (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1]))
    first = np.flatnonzero(new)
    return rows[first], keys[first], np.diff(np.append(first, len(rows)))


def _part(words, i):
    lo, hi = words.first[i], words.first[i + 1]
    return type(words)(np.array([0, hi - lo]), words.row[lo:hi], words.start[lo:hi], words.end[lo:hi], [words.hashes[0][lo:hi]])


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _poisson(seed: np.ndarray, mean: float) -> np.ndarray:
    """Poisson counts of cells from their hashes."""
    terms = mean ** np.arange(MOST_DARTS) / np.cumprod(np.append(1.0, np.arange(1, MOST_DARTS)))
    return np.searchsorted(np.cumsum(np.exp(-mean) * terms), _unit(seed), side="right")


def throw(key: np.ndarray, weight: np.ndarray, level: int, coordinates: int):
    """Darts of elements in one level of ranks: element index, rank, coordinate
    and hash of the accepted ones.

    Level 0 is ranks [0, 1), level n is [2**(n-1), 2**n). Weights are cut in the
    same way, and each strip of weights into cells of area 1 along the rank, so
    that the same darts fall whatever set asks.
    """
    low, height = (0.0, 1.0) if level == 0 else (2.0 ** (level - 1),) * 2
    parts = []
    strip, left, right = 0, 0.0, 1.0
    inside = np.arange(len(key))
    while len(inside):
        cells = int(height * (right - left))
        number = np.tile(np.arange(cells, dtype=np.uint64), len(inside))
        owner = np.repeat(inside, cells)
        tag = np.uint64((level << 8) + strip + 1)
        seed = mix(key[owner] ^ mix((number << np.uint64(20)) + tag))
        found = _poisson(seed, 1.0)
        dart = np.repeat(np.arange(len(owner)), found)
        nth = np.arange(len(dart)) - np.repeat(np.cumsum(found) - found, found)
        s = mix(seed[dart] + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        o = owner[dart]
        w = left + (right - left) * _unit(mix(s ^ np.uint64(0x243F6A8885A308D3)))
        rank = low + height * (number[dart] + _unit(mix(s ^ np.uint64(0x13198A2E03707344)))) / cells
        hit = w < weight[o]
        coordinate = (mix(s ^ np.uint64(0xA4093822299F31D0)) % np.uint64(coordinates)).astype(np.int64)
        parts.append((o[hit], rank[hit], coordinate[hit], s[hit]))
        strip, left, right = strip + 1, right, right * 2
        inside = inside[weight[inside] > left]
    return tuple(map(np.concatenate, zip(*parts, strict=True)))


def signatures(row: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int, coordinates: int = COORDINATES) -> np.ndarray:
    """An n x coordinates array of dart hashes; rows without elements stay 0."""
    total = np.bincount(row, weights=weight, minlength=n)
    wanted = coordinates * np.log(coordinates) + 2 * coordinates
    last = np.full(n, -1, np.int64)
    last[total > 0] = np.maximum(np.ceil(np.log2(wanted / total[total > 0])), 0)
    best = np.full(n * coordinates, np.inf)
    out = np.zeros(n * coordinates, np.uint64)
    level = 0
    while (last >= level).any():
        active = np.flatnonzero(last[row] >= level)
        o, rank, coordinate, mark = throw(key[active], weight[active], level, coordinates)
        place = row[active][o] * coordinates + coordinate
        np.minimum.at(best, place, rank)
        first = rank == best[place]
        out[place[first]] = mark[first]
        # a coordinate that no dart has hit yet takes its row to the next level
        lacking = np.isinf(best.reshape(n, coordinates)).any(axis=1)
        last[(last == level) & lacking] += 1
        level += 1
    return out.reshape(n, coordinates)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, different from band to band."""
    out = np.empty((len(signature), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(signature), b + 1, np.uint64)
        for i in range(rows):
            key = mix(key * np.uint64(0x9FB21C651E98DF25) ^ signature[:, b * rows + i])
        out[:, b] = key
    return out


def codes_of(signature: np.ndarray) -> list[np.ndarray]:
    """The last CODE_BITS bits of all coordinates, packed into 64-bit columns."""
    per = 64 // CODE_BITS
    few = signature & np.uint64((1 << CODE_BITS) - 1)
    shifts = np.arange(per, dtype=np.uint64) * np.uint64(CODE_BITS)
    parts = [few[:, lo : lo + per] for lo in range(0, few.shape[1], per)]
    return [np.bitwise_or.reduce(p << shifts[: p.shape[1]], axis=1).view(np.int64) for p in parts]


def code_columns(coordinates: int) -> list[str]:
    return [f"c{i}" for i in range(-(-coordinates * CODE_BITS // 64))]


def most_unequal(coordinates: int, threshold: float) -> int:
    """Coordinates whose bits may differ: more do with at most LOST in a pair at the
    threshold."""
    p = (1 - threshold) * (1 - 2.0**-CODE_BITS)
    tail = 1.0
    for k in range(coordinates + 1):
        tail -= math.comb(coordinates, k) * p**k * (1 - p) ** (coordinates - k)
        if tail <= LOST:
            return k
    return coordinates


def signed_ddl(coordinates: int) -> str:
    return ", ".join(["row long, id long, digest long, check long, bands array<long>", *(f"{c} long" for c in code_columns(coordinates))])


def sign(batches: Iterator[pa.RecordBatch], size: int, counted: bool, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Band keys of every text, bits of its signature, and a digest of its shingles in
    two halves; no bands without words."""
    names = ["row", "id", "digest", "check", "bands", *code_columns(bands * rows)]
    for batch in batches:
        for start, part in slices(batch.column("text")):
            n = len(part)
            row, key, count = shingles(part, size)
            weight = count.astype(np.float64) if counted else np.ones(len(key))
            signature = signatures(row, key, weight, n, bands * rows)
            keys = band_keys(signature, bands, rows).view(np.int64)
            full = np.bincount(row, minlength=n) > 0
            once = mix(key ^ mix(count.astype(np.uint64) if counted else np.ones(len(key), np.uint64)))
            digest = np.zeros((2, n), np.uint64)
            np.add.at(digest[0], row, once)
            np.add.at(digest[1], row, mix(once ^ np.uint64(0x452821E638D01377)))
            offsets = np.append(0, np.cumsum(np.where(full, bands, 0)))
            yield pa.record_batch(
                [
                    batch.column("row").slice(start, n),
                    batch.column("id").slice(start, n),
                    *(pa.array(d.view(np.int64), mask=~full) for d in digest),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[full].reshape(-1))),
                    *map(pa.array, codes_of(signature)),
                ],
                names=names,
            )


def elements(batches: Iterator[pa.RecordBatch], size: int, counted: bool) -> Iterator[pa.RecordBatch]:
    """The shingles of every text; the n-th occurrence is an element of its own if counted."""
    for batch in batches:
        ids = batch.column("id")
        for start, part in slices(batch.column("text")):
            row, key, count = shingles(part, size)
            if counted:
                nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                row, key = np.repeat(row, count), np.repeat(key, count)
                key = np.where(nth > 0, mix(key + nth.astype(np.uint64)), key)
            offsets = np.append(0, np.cumsum(np.bincount(row, minlength=len(part))))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(key.view(np.int64)))
            yield pa.record_batch([ids.slice(start, len(part)), lists], names=["id", "elements"])


def alike(pairs: DataFrame, copies: DataFrame, coordinates: int, threshold: float) -> DataFrame:
    """The pairs ``(a, b)`` whose signatures agree often enough for the threshold."""
    names = code_columns(coordinates)
    left, right = (copies.select(F.col("rep").alias(x), *(F.col(c).alias(f"{x}{c}") for c in names)) for x in ("a", "b"))
    # a set bit for every coordinate that differs
    odd = F.lit(0x5555555555555555)
    unequal = F.lit(0)
    for c in names:
        x = F.col(f"a{c}").bitwiseXOR(F.col(f"b{c}"))
        unequal = unequal + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(odd))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(unequal <= most_unequal(coordinates, threshold)).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` whose sets have at least that Jaccard similarity."""
    # (merged at every size, so that the pairs are never what is broadcast)
    left = sets.select(F.col("id").alias("a"), F.col("elements").alias("x")).hint("merge")
    right = sets.select(F.col("id").alias("b"), F.col("elements").alias("y")).hint("merge")
    common = F.size(F.array_intersect("x", "y"))
    joined = pairs.join(left, "a").join(right, "b")
    similarity = common / (F.size("x") + F.size("y") - common)
    return joined.select("a", "b", similarity.alias("similarity")).where(F.col("similarity") >= threshold)


def jaccard(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Similarities of sets by one matrix product over their joint elements."""
    sizes = np.array([len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = int(column[-1]) + 1
    wide = min(total, max(1, MATRIX // len(sets)))
    common = np.zeros((len(first), len(second)))
    for lo in range(0, total, wide):
        a, b = np.searchsorted(column, [lo, lo + wide])
        holds = np.zeros((len(sets), wide), np.float32)
        holds[owner[a:b], column[a:b] - lo] = 1
        common += holds[first] @ holds[second].T
    return common / (sizes[first][:, None] + sizes[second][None, :] - common)


def sift(batches: Iterator[pa.RecordBatch], names: list[str], most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a block pair that have a row of another component opposite whose
    signature differs in ``most`` coordinates at most, and with which they share no
    earlier band: every such pair is left in one bucket."""
    odd = np.uint64(0x5555555555555555)
    for g in groups(batches, ["key", "low", "high"]):
        c, block = (g.column(n).to_numpy(zero_copy_only=False) for n in ("c", "block"))
        low, high = g.column("low")[0].as_py(), g.column("high")[0].as_py()
        first = np.flatnonzero(block == low)
        second = first if low == high else np.flatnonzero(block == high)
        if not len(first) or not len(second):
            continue
        bands = g.column("bands").flatten().to_numpy(zero_copy_only=False).reshape(len(g), -1)
        band = int(np.flatnonzero(bands[0] == g.column("key")[0].as_py())[0])
        codes = np.stack([g.column(n).to_numpy(zero_copy_only=False).view(np.uint64) for n in names], axis=1)
        keep = np.zeros(len(g), bool)
        step = max(1, (1 << 20) // len(second))
        for lo in range(0, len(first), step):
            part = first[lo : lo + step]
            unequal = np.zeros((len(part), len(second)), np.int64)
            for i in range(len(names)):
                x = codes[part, i][:, None] ^ codes[second, i][None, :]
                unequal += np.bitwise_count((x | (x >> np.uint64(1))) & odd)
            near = (unequal <= most) & (c[part][:, None] != c[second][None, :])
            for i in range(band):
                near &= bands[part, i][:, None] != bands[second, i][None, :]
            keep[part] |= near.any(axis=1)
            keep[second] |= near.any(axis=0)
        if keep.any():
            yield pa.Table.from_batches([g.drop_columns(["bands", *names])]).filter(pa.array(keep)).combine_chunks().to_batches()[0]


def compare(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links between rows of a block pair that are in different components so far,
    as many as it takes to connect what they connect."""
    for g in groups(batches, ["key", "low", "high"]):
        ids, c, block = (g.column(n).to_numpy(zero_copy_only=False) for n in ("id", "c", "block"))
        low, high = g.column("low")[0].as_py(), g.column("high")[0].as_py()
        first = np.flatnonzero(block == low)
        second = first if low == high else np.flatnonzero(block == high)
        # rows of one component are not compared with each other
        if len(np.unique(c)) < 2 or not len(first) or not len(second):
            continue
        sets = [x.values.to_numpy(zero_copy_only=False) for x in g.column("elements")]
        linked = (jaccard(sets, first, second) >= threshold) & (c[first][:, None] != c[second][None, :])
        if linked.any():
            root = roots(ids, first, second, linked)
            moved = root != ids
            yield pa.record_batch([ids[moved], root[moved]], names=["a", "b"])


def near_groups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    counted: bool = False,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, component_id, kept``.

    Documents are linked when their sets of ``shingle`` consecutive words have a
    Jaccard similarity of ``threshold`` or more (``counted``: sets weighted by
    the times a shingle occurs); ``component_id`` is the smallest id reachable by
    links, ``kept`` marks one row per component, that of the smallest id. Words
    are runs of letters and digits, A-Z folded.

    Texts with equal shingles are one node from the start. In every band the
    documents of a bucket are compared with its smallest id; what this leaves in
    different components of one bucket is then compared in full, so that no
    bucket's pairs are ever listed. Candidates whose signatures differ too often are
    dropped (of pairs at the threshold at most one in ten million); all others are
    confirmed on the shingles themselves.

    Null, empty and word-less texts are linked with nothing. Rows with one id
    are one node (a null id counts as the largest and is returned as null), of
    which one row may be kept. An empty table gives an empty result.
    """
    coordinates = bands * band_rows
    text = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(text_col).alias("text"),
    )
    signed = stage(text.mapInArrow(lambda b: sign(b, shingle, counted, bands, band_rows), signed_ddl(coordinates)), "signed")
    own = ["bands", *code_columns(coordinates)]
    full = signed.where("digest is not null")
    copies = full.groupBy("digest", "check").agg(F.min("id").alias("rep"), F.any_value(F.struct(*own)).alias("own"))
    copies = stage(copies.select("digest", "check", "rep", "own.*"), "copies")
    same = full.select("digest", "check", "id").join(copies.select("digest", "check", "rep"), ["digest", "check"])
    same = same.select("id", "rep").where("id <> rep")
    keys = copies.select(F.col("rep").alias("id"), F.explode("bands").alias("key"))
    lowest = keys.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").drop("high")
    buckets = stage(keys.join(lowest, "key"), "buckets")
    stars = buckets.where("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b")).distinct()
    stars = stage(alike(stars, copies, coordinates, threshold), "stars")
    # texts of which shingles are needed: ids in a bucket
    wanted, flag = in_bits(text.select("id", "text"), "id", stage(buckets.select("id").distinct(), "ids"))
    sets = wanted.where(flag).select("id", "text").mapInArrow(lambda b: elements(b, shingle, counted), "id long, elements array<long>")
    sets = stage(sets.withColumn("weight", F.size("elements")).where("weight > 0"), "sets")
    links = stage(verified(stars, sets, threshold).select("a", "b"), "links")
    # what shares a bucket but not yet a component
    grouped = components(links)
    # (all pairs with the bucket's smallest id have been compared)
    placed = buckets.where("id <> low").select("key", "id").join(grouped, "id", "left").select("key", "id", F.coalesce("component_id", "id").alias("c"))
    mixed = placed.groupBy("key").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 < c2").select("key")
    order = ["key", "low", "high"]
    codes = code_columns(coordinates)
    opened = placed.join(mixed, "key").join(copies.select(F.col("rep").alias("id"), "bands", *codes), "id")
    opened = stage(opened.join(sets.select("id", "weight"), "id"), "open")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def together(rows: DataFrame) -> DataFrame:
        return rows.repartition(partitions, *order).sortWithinPartitions(*order)

    # only rows whose signature is near another's in the bucket meet with their shingles
    most, kept = most_unequal(coordinates, threshold), [*order, "block", "id", "c"]
    pairs = together(in_block_pairs(opened, ["key"], BLOCK, BLOCK_SHINGLES).select(*kept, "bands", *codes))
    near = stage(pairs.mapInArrow(lambda b: sift(b, codes, most), pairs.select(*kept).schema), "near")
    work = together(near.join(sets.drop("weight"), "id"))
    more = work.select(*order, "block", "id", "c", "elements").mapInArrow(
        lambda b: compare(b, threshold), "a long, b long"
    )
    found = components(links.union(more).union(same.toDF("a", "b")))
    # of rows that repeat an id, one
    again = signed.groupBy("id").agg(F.min("row").alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    placed = signed.select("row", "id").join(found, "id", "left").join(stage(again, "again"), "id", "left")
    component = F.coalesce("component_id", "id")
    return placed.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        F.when(component != NO_ID, component).alias("component_id"),
        ((component == F.col("id")) & F.coalesce(F.col("row") == F.col("first"), F.lit(True))).alias("kept"),
    )
