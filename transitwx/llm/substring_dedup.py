"""Removal of repeated passages, by level-wise doubling of word windows.

Windows of about half the wanted length come first; those that repeat are
extended to twice that length (at last to the wanted one), and so on until the
length is reached or no candidate survives. On the first level a window of the
next length is stood for by one of its own parts, the one with the smallest
hash, so that only a quarter of all short windows is compared and still no
repeat is missed.

A task first settles what it can see itself: of equal windows in a block of
documents only the one in the smallest document is compared with other blocks.
A window that a third of all documents hold then comes once per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from transitwx.llm.tokens import mix, plain_table, slices, valid_windows, windows, words_of
from transitwx.session import stage

WINDOW = 13
#: A null id counts as the largest.
NO_ID = (1 << 63) - 1
#: Text bytes of the documents whose windows a task compares at once.
BLOCK_BYTES = 4 << 20
#: A window, or (``at`` empty, ``key`` arbitrary) a list of windows of one
#: document that its block has settled.
PAIRS = pa.schema(
    [
        ("key", pa.int64()),
        ("check", pa.int64()),
        ("id", pa.int64()),
        ("text_hash", pa.int64()),
        ("at", pa.int32()),
        ("repeats", pa.list_(pa.int32())),
        ("covered", pa.list_(pa.int32())),
    ]
)
PAIRS_DDL = "key long, check long, id long, text_hash long, at int, repeats array<int>, covered array<int>"


def level_sizes(window: int) -> list[int]:
    """Window lengths of the levels, rising: halves of the wanted length, rounded
    up, down to 7 words or less than 8."""
    sizes = [window]
    while sizes[0] >= 8:
        sizes.insert(0, (sizes[0] + 1) // 2)
        if sizes[0] <= 7:
            break
    return sizes


def smallest_parts(h: np.ndarray, row: np.ndarray, count: int) -> np.ndarray:
    """Indices of the leftmost smallest of each ``count`` consecutive windows of a row."""
    if len(h) < count:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(h, count)
    at = np.arange(len(view)) + view.argmin(axis=1)
    return np.unique(at[row[: len(view)] == row[count - 1 : count - 1 + len(view)]])


def settle(ids: np.ndarray, key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of a block repeat in it, and which have a smaller id in it.

    The others, those of the smallest id of their key, are still to be compared
    with other blocks.
    """
    order = np.lexsort((ids, check, key))
    k, c, d = key[order], check[order], ids[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    group = np.cumsum(new) - 1
    firsts = np.flatnonzero(new)
    low, high = d[firsts], d[np.append(firsts[1:], len(k)) - 1]
    repeats, covered = np.empty(len(k), bool), np.empty(len(k), bool)
    repeats[order] = (high > low)[group]
    covered[order] = d > low[group]
    return repeats, covered


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """The rows in blocks of about ``limit`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        at = 0
        for start, part in slices(batch.column("text"), limit):
            piece = batch.slice(start, len(part))
            held.append(piece)
            size += piece.nbytes
            at += len(part)
            if size >= limit:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _lists(rows: np.ndarray, at: np.ndarray, wanted: np.ndarray, n: int) -> pa.Array:
    """Lists of ``at`` by row; rows come in order."""
    counts = np.bincount(rows[wanted], minlength=n)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(at[wanted], pa.int32()))


def emit(ids, hashes, rows, at, key, check) -> Iterator[pa.RecordBatch]:
    """The windows to be compared, and what the block has settled."""
    repeats, covered = settle(ids[rows], key, check)
    n = len(ids)
    settled = np.unique(rows[repeats])
    own = mix(hashes.view(np.uint64) ^ mix(ids.view(np.uint64))).view(np.int64)
    nothing = pa.array(np.zeros(n, np.int64))
    lists = [_lists(rows, at, repeats, n), _lists(rows, at, covered, n)]
    yield pa.record_batch(
        [pa.array(own), nothing, pa.array(ids), pa.array(hashes), pa.nulls(n, pa.int32()), *lists], schema=PAIRS
    ).take(pa.array(settled))
    left = np.flatnonzero(~covered)
    for lo in range(0, len(left), 50_000):
        i = left[lo : lo + 50_000]
        r, empty = rows[i], pa.nulls(len(i), pa.list_(pa.int32()))
        yield pa.record_batch(
            [key[i].view(np.int64), check[i].view(np.int64), ids[r], hashes[r], at[i].astype(np.int32), empty, empty],
            schema=PAIRS,
        )


def first_level(batches: Iterator[pa.RecordBatch], size: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Short windows that stand for the windows of the next length."""
    table = plain_table()
    for block in blocks(batches):
        ids = _column(block, "id").to_numpy(zero_copy_only=False)
        hashes = _column(block, "text_hash").to_numpy(zero_copy_only=False)
        rows, at, key = [], [], []
        for start, column in slices(_column(block, "text")):
            words = words_of(column, table)
            h = windows(words, size)
            ok = valid_windows(words, size)
            row = np.where(ok, words.row[: len(h)], -1 - np.arange(len(h))) if parts == 1 else words.row[: len(h)]
            if parts == 1:
                pick = np.flatnonzero(ok)
            else:
                pick = smallest_parts(np.where(ok, h, np.uint64(2**64 - 1)), row, parts)
                pick = pick[ok[pick]]
            r = words.row[pick]
            rows.append(r + start)
            at.append(pick - words.first[r])
            key.append(h[pick])
        if rows:
            keys = np.concatenate(key)
            yield from emit(ids, hashes, np.concatenate(rows), np.concatenate(at), keys, np.zeros_like(keys))


def next_level(
    batches: Iterator[pa.RecordBatch], size: int, before: int, sampled: bool
) -> Iterator[pa.RecordBatch]:
    """Windows of ``size`` words whose parts of ``before`` words all repeat.

    ``starts`` holds where repeated parts begin. After the first, sampled level a
    window goes on if the part that stands for it repeats; later ones if the
    parts at its two ends do.
    """
    table = plain_table()
    for block in blocks(batches):
        ids = _column(block, "id").to_numpy(zero_copy_only=False)
        hashes = _column(block, "text_hash").to_numpy(zero_copy_only=False)
        starts = _column(block, "starts")
        flat, offsets = starts.flatten().to_numpy(zero_copy_only=False), starts.offsets.to_numpy()
        rows, at, key, check = [], [], [], []
        for start, column in slices(_column(block, "text")):
            words = words_of(column, table, hashes=2)
            n = len(words.row) - size + 1
            if n <= 0:
                continue
            marked = np.zeros(len(words.row), bool)
            lo, hi = offsets[start - 0], offsets[start + len(column)]
            owner = np.repeat(np.arange(len(column)), np.diff(offsets[start : start + len(column) + 1]))
            marked[words.first[owner] + flat[lo - offsets[0] : hi - offsets[0]]] = True
            if sampled:
                h = windows(words, before)
                good = valid_windows(words, before)
                view = np.lib.stride_tricks.sliding_window_view(np.where(good, h, np.uint64(2**64 - 1)), size - before + 1)
                ok = marked[np.arange(n) + view.argmin(axis=1)[:n]]
            else:
                ok = marked[:n] & marked[size - before : size - before + n]
            pick = np.flatnonzero(ok & valid_windows(words, size))
            r = words.row[pick]
            rows.append(r + start)
            at.append(pick - words.first[r])
            key.append(windows(words, size)[pick])
            check.append(windows(words, size, 1)[pick])
        if rows:
            yield from emit(ids, hashes, *map(np.concatenate, (rows, at, key, check)))


def kept_words(text: str | None, starts, window: int) -> tuple[int, int, bytes]:
    """Number of words, number removed, and the kept words joined by one space."""
    words = (text or "").encode().split()
    if not len(starts):
        return len(words), 0, b" ".join(words)
    change = np.zeros(len(words) + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(np.asarray(starts) + window, len(words)), -1)
    keep = np.cumsum(change[:-1]) == 0
    return len(words), int(len(words) - keep.sum()), b" ".join(compress(words, keep))


RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string())])


def finish(batches: Iterator[pa.RecordBatch], window: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, part in slices(batch.column("text"), BLOCK_BYTES):
            piece = batch.slice(start, len(part))
            covered = piece.column("starts")
            out = []
            for i, (doc_id, text) in enumerate(zip(piece.column("doc_id").to_pylist(), part, strict=True)):
                starts = covered[i].values.to_numpy(zero_copy_only=False) if covered[i].is_valid else ()
                n, gone, kept = kept_words(text.as_py(), starts, window)
                # equal texts in smaller documents cover a text from end to end
                if piece.column("copied")[i].as_py() and n >= window:
                    gone, kept = n, b""
                out.append((doc_id, n, gone, kept.decode() if with_text else None, sha256(kept).hexdigest()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), RESULT.types, strict=True)], schema=RESULT)


def repeated(found: DataFrame, last: bool) -> DataFrame:
    """Per document, where the windows that go on begin: those that repeat in
    another document or, on the last level, in a smaller one."""
    same = Window.partitionBy("key", "check")
    low, high = F.min("id").over(same), F.max("id").over(same)
    other = (F.col("id") > low) if last else (low < high)
    starts = F.when(F.col("at").isNull(), F.col("covered" if last else "repeats")).when(other, F.array("at"))
    rows = found.select("id", "text_hash", starts.alias("part")).where(F.size("part") > 0)
    return rows.groupBy("id", "text_hash").agg(F.array_distinct(F.flatten(F.collect_list("part"))).alias("starts"))


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept, kept_sha256``.

    Words are runs of bytes other than space and 0x09-0x0D. A word is removed if
    some ``window`` consecutive words of its document that hold it also begin in
    a document with a smaller id; all windows are judged on the input. ``kept``
    is the rest joined by single spaces (null unless ``with_text``).

    Windows are told apart by 128 bits of hash on the last level. Null texts have
    no words. A null id counts as the largest. Repeated ids do not cover each
    other. Texts shorter than ``window`` stay whole. An empty table gives an
    empty result; other columns are not read.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    docs = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"),
    )
    # a text that a smaller document has too is covered whole; it needs no windows
    equal = stage(docs.select("id", "text_hash", F.sha2("text", 256).alias("digest")), "digests")
    first = equal.groupBy("digest").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    # rows are told apart by id alone unless an id has several texts
    if equal.groupBy("id").agg((F.min("text_hash") != F.max("text_hash")).alias("several")).where("several").isEmpty():
        docs, equal = (df.withColumn("text_hash", F.lit(0).cast("long")) for df in (docs, equal))
    copies = (
        equal.join(first, "digest").where("id > low").select("id", "text_hash", F.lit(True).alias("copied")).distinct()
    )
    sizes = level_sizes(window)
    text = docs.select("id", "text_hash", "text")
    size, bigger = sizes[0], (sizes + [None])[1]
    parts = bigger - size + 1 if bigger else 1
    found = text.mapInArrow(lambda b: first_level(b, size, parts), PAIRS_DDL)
    for n, (before, size) in enumerate(zip(sizes, sizes[1:], strict=False)):
        # copies stand behind their first text, which has the same windows
        starts = stage(repeated(found, False).join(copies, ["id", "text_hash"], "left_anti"), "starts")
        found = text.join(starts, ["id", "text_hash"]).mapInArrow(
            lambda b, size=size, before=before, sampled=n == 0: next_level(b, size, before, sampled), PAIRS_DDL
        )
    covered = stage(repeated(found, True), "covered")
    marks = covered.join(copies, ["id", "text_hash"], "full")
    return docs.join(marks, ["id", "text_hash"], "left").select("doc_id", "text", "starts", "copied").mapInArrow(
        lambda b: finish(b, window, with_text),
        "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string",
    )
