"""Benchmark decontamination by spaced seeds.

A mask keeps some places of a run of words and ignores the others, so a changed
word at an ignored place does not hide the run. Hashes of all masked runs of the
documents are joined with those of the benchmark; around every hit the words of
both sides are compared one by one along the same diagonal.

Two small sets spare the text a shuffle: a table of bits of the benchmark's hashes
lets tasks drop most runs that meet nothing, and another of the ids with hits lets
them drop most texts before these meet their hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitwx.llm.bits import bit_array, in_bits, without
from transitwx.llm.tokens import folded_table, mix, slices, words_of
from transitwx.session import stage

#: Fixed masks: 1 compares a word, 0 ignores it. Eight words each.
MASKS = ("11111111", "1101100101011", "1110010110011", "1011010011011", "1100111010101")
#: Overlaps shorter than this count only if they are a whole benchmark item.
MIN_WORDS = 13
#: Least share of equal words in an overlap.
MIN_IDENTITY = 0.8
#: Hits of a document that are looked at together.
LINES = 256
ODD = 0x9FB21C651E98DF25


def masked(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the masked run from each word on."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, int(mask, 2) + (len(mask) << 40), np.uint64)
    for i, keep in enumerate(mask):
        if keep == "1":
            total = (total ^ h[i : i + n]) * np.uint64(ODD)
            total ^= total >> np.uint64(32)
    return mix(total)


SEEDS = pa.schema([("hash", pa.int64()), ("id", pa.int64()), ("at", pa.int32())])
SEEDS_DDL = "hash long, id long, at int"


def seeds(batches: Iterator[pa.RecordBatch], masks: tuple[str, ...], bits: np.ndarray | None, whole: int = 0) -> Iterator[pa.RecordBatch]:
    """Masked runs and where they begin; if ``bits`` are given, without most of those
    that are not in them. Masks shorter than ``whole`` fit whole texts only."""
    table = folded_table()
    for batch in batches:
        ids = batch.column("id")
        for start, part in slices(batch.column("text")):
            words = words_of(part, table)
            for mask in masks:
                keys = masked(words.hashes[0], mask).view(np.int64)
                ok = words.row[: len(keys)] == words.row[len(mask) - 1 : len(mask) - 1 + len(keys)]
                if len(mask) < whole:
                    ok &= np.diff(words.first)[words.row[: len(keys)]] == len(mask)
                if bits is not None:
                    at = keys & (8 * len(bits) - 1)
                    ok &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                pick = np.flatnonzero(ok)
                row = words.row[pick]
                for lo in range(0, len(pick), 50_000):
                    p, r = pick[lo : lo + 50_000], row[lo : lo + 50_000]
                    yield pa.record_batch([keys[p], ids.take(pa.array(r + start)), (p - words.first[r]).astype(np.int32)], schema=SEEDS)


def word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word hashes of every text."""
    table = folded_table()
    for batch in batches:
        for start, part in slices(batch.column("text")):
            words = words_of(part, table)
            lists = pa.ListArray.from_arrays(pa.array(words.first, pa.int32()), pa.array(words.hashes[0].view(np.int64)))
            yield pa.record_batch([batch.column("id").slice(start, len(part)), lists], names=["id", "words"])


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, identity: Fraction) -> tuple[int, int, int]:
    """The longest overlap of two word lists where ``item[i]`` meets
    ``doc[i + shift]``: where it begins in ``doc``, its words and the equal ones
    among them. It is the longest run with the share ``identity`` of equal words
    that begins and ends with an equal one; of several, the first."""
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    same = doc[lo + shift : hi + shift] == item[lo:hi]
    first = np.flatnonzero(same)
    if not len(first):
        return 0, 0, 0
    # a run qualifies if the weights of its words do not add up below 0
    up, down = identity.denominator - identity.numerator, -identity.numerator
    total = np.append(0, np.cumsum(np.where(same, up, down)))
    highest = np.maximum.accumulate(total[first + 1][::-1])[::-1]
    last = first[np.searchsorted(-highest, -total[first], side="right") - 1]
    best = int((last - first).argmax())
    begin, end = int(first[best]), int(last[best]) + 1
    return lo + shift + begin, end - begin, int(same[begin:end].sum())


MATCH_DDL = "doc_id long, item_id long, start int, words int, equal int, item_words int"
MATCH = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64())] + [(n, pa.int32()) for n in ("start", "words", "equal", "item_words")]
)


def verify(batches: Iterator[pa.RecordBatch], min_words: int, min_identity: float) -> Iterator[pa.RecordBatch]:
    """Overlaps along the diagonals of hits that are long and alike enough."""
    identity = Fraction(min_identity).limit_denominator(1000)
    for batch in batches:
        out = []
        for k, (doc_id, lines) in enumerate(zip(batch.column("id").to_pylist(), batch.column("lines"), strict=True)):
            h = batch.column("words")[k].values.to_numpy(zero_copy_only=False)
            items, shifts, words = (lines.values.field(n) for n in ("item_id", "shift", "b_words"))
            for i, (item_id, shift) in enumerate(zip(items.to_pylist(), shifts.to_pylist(), strict=True)):
                item = words[i].values.to_numpy(zero_copy_only=False)
                at, length, equal = overlap(h, item, shift, identity)
                if length and length >= min(min_words, len(item)):
                    out.append((doc_id, item_id, at, length, equal, len(item)))
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), MATCH.types, strict=True)], schema=MATCH)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[str, ...] = MASKS,
    min_words: int = MIN_WORDS,
    min_identity: float = MIN_IDENTITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document and item that overlap: ``doc_id, item_id, start,
    words, equal, item_words``, the longest overlap of the two.

    Words are runs of letters and digits, A-Z folded. An overlap is a run of
    words of the document that equals a run of the item but for changed words; it
    counts from ``min_words`` words on, or as long as a shorter item, with
    ``min_identity`` of its words equal, the first and the last among them. It is
    found if a mask meets equal words somewhere on its line (all masks have eight
    words that count: a run of eight equal words is always met). ``start`` is the
    document's word at which it begins. Items with fewer words than the shortest
    mask must occur whole.

    Null and empty texts overlap with nothing; rows without an id are read like
    others, and a null id is returned as null. Repeated rows give one row.
    Without items or documents the result is empty.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text")).where("text is not null")
    lists = stage(items.distinct().mapInArrow(word_lists, "id long, words array<long>").where("size(words) > 0"), "items")
    shortest = min(map(len, masks))
    short = [r[0] for r in lists.select(F.size("words").alias("n")).where(F.col("n") < shortest).distinct().collect()]
    runs = (*masks, *("1" * n for n in sorted(short)))  # at most shortest - 1 more
    known = stage(items.distinct().mapInArrow(lambda b: seeds(b, runs, None, shortest), SEEDS_DDL), "item-seeds")
    shared = docs.sparkSession.sparkContext.broadcast(bit_array(known.select("hash").distinct(), "hash"))
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    met = known.select("hash", F.col("id").alias("item_id"), F.col("at").alias("b_at"))
    hits = text.mapInArrow(lambda b: seeds(b, runs, shared.value), SEEDS_DDL).join(met, "hash")
    lines = stage(hits.select("id", "item_id", (F.col("at") - F.col("b_at")).alias("shift")).distinct(), "hits")
    # the hits of a document side by side, in lists of bounded length
    ids = stage(lines.groupBy("id").agg(F.ceil(F.count("*") / LINES).cast("int").alias("parts")), "hit-ids")
    many = ids.where("parts > 1").select(F.col("id").alias("hit"), "parts")
    lines = lines.join(many, F.col("id").eqNullSafe(F.col("hit")), "left").drop("hit")
    part = F.pmod(F.xxhash64("item_id", "shift"), F.coalesce("parts", F.lit(1)))
    lines = lines.select("id", "item_id", "shift", part.alias("part")).join(
        lists.select(F.col("id").alias("item"), F.col("words").alias("b_words")), F.col("item_id").eqNullSafe(F.col("item"))
    )
    together = lines.groupBy("id", "part").agg(F.collect_list(F.struct("item_id", "shift", "b_words")).alias("lines"))
    near, flag = in_bits(text, "id", ids.select("id"))
    words = near.where(flag).select("id", "text").mapInArrow(word_lists, "id long, words array<long>")
    words = words.where("size(words) > 0").select(F.col("id").alias("own"), "words")
    found = (
        together.join(words, F.col("id").eqNullSafe(F.col("own")))
        .select("id", "lines", "words")
        .mapInArrow(lambda b: verify(b, min_words, min_identity), MATCH_DDL)
    )
    best = F.max(F.struct("words", "equal", (-F.col("start")).alias("start"), "item_words")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("best.start")).alias("start"), "best.words", "best.equal", "best.item_words"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """``docs`` without the documents that overlap with a benchmark item; rows
    with a null id stay only if no such row overlaps."""
    bad = find_contamination(docs, benchmark, id_col=id_col, **settings).select("doc_id").distinct()
    return without(docs, id_col, stage(bad, "contaminated"))
