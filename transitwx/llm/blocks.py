"""Rows of one key compared with each other in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_block_pairs(rows: DataFrame, key: list[str], block: int, heavy: int | None = None) -> DataFrame:
    """Deal the rows (with an ``id``) of every key with two rows or more into blocks
    of about ``block`` rows, and every row into all pairs ``low <= high`` of its
    block with a block of the key. A key of n rows makes n * n / block rows, one
    pair of blocks is one task's bounded work, and no pair of rows is a row.

    With ``heavy``, the ``weight`` of a block's rows is about that at most, too,
    or that of a single row."""
    total = F.count("*") if heavy is None else F.greatest(F.count("*"), F.sum("weight") * F.lit(block) / F.lit(heavy))
    counts = rows.groupBy(*key).agg(F.count("*").alias("rows"), total.alias("load")).where("rows > 1")
    # (no more blocks than rows)
    parts = F.ceil(F.least(F.col("load") / block, F.col("rows"))).cast("int")
    dealt = rows.join(counts, key).withColumn("blocks", parts)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return (
        dealt.withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("rows", "load", "weight", "blocks", "other")
    )


def groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of equal ``names`` of rows that come sorted by them, each as one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        change = np.zeros(len(batch), bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), len(batch)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[lo] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def roots(ids: np.ndarray, first: np.ndarray, second: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """The smallest id that every row reaches by links between the rows ``first``
    and ``second``."""
    label, big = ids.copy(), np.iinfo(np.int64).max
    while True:
        down = np.minimum(label[first], np.where(linked, label[second][None, :], big).min(axis=1))
        new = label.copy()
        new[first] = down
        new[second] = np.minimum(new[second], np.where(linked, down[:, None], big).min(axis=0))
        if (new == label).all():
            return label
        label = new
