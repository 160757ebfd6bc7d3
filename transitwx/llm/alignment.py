"""Alignment of two tokenizers by merging the ends of their tokens.

The ends of a text's A tokens and of its B tokens are two sorted lists. Where they
hold the same byte offset, both tokenizations have a border, and the tokens between
two such offsets form a group. The two lists are merged along the merge path:
binary searches on diagonals of the merge grid cut the work into pieces of equal
size that know nothing of each other. A piece gives the ends common to its two
parts, and a last look at the borders between pieces stitches ends that a diagonal
has parted.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitwx.llm.tokens import slices
from transitwx.session import stage

#: Token ends of a piece.
PIECE = 1 << 15
#: Text of a slice and rows of it.
SLICE_BYTES = 1 << 20
#: Characters of a long text that are encoded at once.
LONG_TEXT = 1 << 20
#: Pieces of text whose tokens a task remembers, and their characters.
REMEMBERED, REMEMBERED_CHARS = 300_000, 1 << 23
#: Id pairs whose counts every task gets (24 bytes each); rarer ones are joined.
POPULAR = 1 << 20
#: Groups whose ids are written out at once.
GROUPS = 1 << 17
#: Ids fit in so many bits.
ID_BITS = 24
#: Where no token of either kind can reach across: before a single space that
#: follows and precedes something else than white space.
CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible
    characters of Latin-1 for themselves, the others in turn from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or (b >= 161 and b != 173)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Tokenizer:
    """``encode`` gives the ids of pieces of text, each with a space before it."""

    encode: object
    token_bytes: list[bytes]


def byte_level(path: str) -> Tokenizer:
    """A byte-level BPE vocabulary file; strings of special tokens are plain text.

    Its merges stand in the order of their ids, which is checked, so that ids are
    ranks. (The encoder used agrees with the file's own library on texts around
    every code point, and takes a quarter of its time.)
    """
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    vocabulary, letters = data["model"]["vocab"], byte_letters()
    merges = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
    if any(vocabulary[a + b] != 256 + i for i, (a, b) in enumerate(merges)):
        raise ValueError(f"{path}: the ids are not in the order of the merges")
    special = {t["content"] for t in data["added_tokens"]}
    ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if t not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    model = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    token_bytes = [b""] * (max(ranks.values()) + 1)
    for t, i in ranks.items():
        token_bytes[i] = t
    return Tokenizer(lambda parts: [model.encode_ordinary(" " + p) for p in parts], token_bytes)


def sentence_pieces(path: str) -> Tokenizer:
    """A BPE piece model with byte fallback, which puts a space before every text."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    token_bytes = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if "▁" in piece.lstrip("▁"):
            raise ValueError(f"{path}: piece {piece!r} reaches across a space")
        token_bytes.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return Tokenizer(lambda parts: model.encode(parts, num_threads=1), token_bytes)


class Grown:
    """An array that is added to."""

    def __init__(self):
        self.data, self.size = np.zeros(1 << 12, np.int32), 0

    def add(self, values) -> None:
        while self.size + len(values) > len(self.data):
            self.data = np.append(self.data, np.zeros(len(self.data), np.int32))
        self.data[self.size : self.size + len(values)] = values
        self.size += len(values)


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of ``data`` one after the other."""
    ends = np.cumsum(sizes)
    return data[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Pair:
    """Both tokenizers, and what a task remembers of pieces of text: tokens never
    reach across a cut, so a piece has the same tokens wherever it stands."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = byte_level(a_path), sentence_pieces(b_path)
        if max(len(self.a.token_bytes), len(self.b.token_bytes)) > 1 << ID_BITS:
            raise ValueError("ids are too large")
        self.sizes = [np.array([len(t) for t in k.token_bytes], np.int64) for k in (self.a, self.b)]
        self.digits = [decimals(len(k.token_bytes)) for k in (self.a, self.b)]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.tokens = (Grown(), Grown())
        self.starts: tuple[list[int], list[int]] = ([], [])
        self.whole: list[bool] = []

    def learn(self, parts: list[str]) -> None:
        """Remember pieces: their tokens of both kinds, and whether these give the
        piece back byte by byte."""
        wanted = [(" " + p).encode() for p in parts]
        whole = [True] * len(parts)
        for kind, grown, starts in zip((self.a, self.b), self.tokens, self.starts, strict=True):
            texts = kind.token_bytes
            for i, ids in enumerate(kind.encode(parts)):
                starts.append(grown.size)
                grown.add(ids)
                whole[i] &= b"".join([texts[t] for t in ids]) == wanted[i]
        self.known.update(zip(parts, range(len(self.whole), len(self.whole) + len(parts)), strict=True))
        self.whole += whole
        self.chars += sum(map(len, parts))

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and of B of all texts in turn, and their numbers per text. A text
        that either tokenizer does not give back, or an empty one, has none."""
        if len(self.known) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.forget()
        rows = [[p for stretch in stretches(t) for p in CUT.split(stretch)] if t else [] for t in texts]
        parts = [p for r in rows for p in r]
        if new := [p for p in dict.fromkeys(parts) if p not in self.known]:
            self.learn(new)
        used = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        lost = np.bincount(row, weights=~np.array(self.whole, bool)[used], minlength=len(rows)) > 0
        used, row = used[~lost[row]], row[~lost[row]]
        ids, counts = [], []
        for grown, starts in zip(self.tokens, self.starts, strict=True):
            at = np.array([*starts, grown.size], np.int64)
            n = np.diff(at)[used]
            ids.append(gathered(grown.data, at[used], n))
            counts.append(np.bincount(row, weights=n, minlength=len(rows)).astype(np.int64))
        return ids, counts


def stretches(text: str) -> Iterator[str]:
    """A long text in parts of about LONG_TEXT characters, cut where tokens can't
    reach across; the space at a cut is left out."""
    at = 0
    while len(text) - at > LONG_TEXT:
        cut = CUT.search(text, at + LONG_TEXT)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


@cache
def pair(a_path: str, b_path: str) -> Pair:
    """One for each Python worker."""
    return Pair(a_path, b_path)


def diagonals(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge path of two sorted arrays crosses every ``piece``-th diagonal
    of the grid: how many entries of each lie before. Of equal ones, A's come first."""
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, piece), total)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while True:
        at = np.flatnonzero(low < high)
        if not len(at):
            return low, d - low
        middle = (low[at] + high[at]) // 2
        first = a[middle] <= b[d[at] - 1 - middle]
        low[at[first]] = middle[first] + 1
        high[at[~first]] = middle[~first]


def common_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the entries that two strictly rising arrays have in common."""
    i, j = diagonals(a, b, piece)
    found = []
    for p in range(len(i) - 1):
        left, right = a[i[p] : i[p + 1]], b[j[p] : j[p + 1]]
        if len(left) and len(right):
            at = np.minimum(np.searchsorted(right, left), len(right) - 1)
            hit = np.flatnonzero(right[at] == left)
            found.append((i[p] + hit, j[p] + at[hit]))
        # A's last end may have met its like at the head of the next piece
        if len(left) and j[p + 1] < len(b) and a[i[p + 1] - 1] == b[j[p + 1]]:
            found.append((i[p + 1 : p + 2] - 1, j[p + 1 : p + 2]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


ALIGNED_DDL = "row long, id long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"
NAMES = ("a_ids", "b_ids", "a_cuts", "b_cuts")


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def aligned(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    """Ids of both kinds and, for every group, how many tokens of each end by its end."""
    tools = pair(a_path, b_path)
    for batch in batches:
        for start, part in slices(batch.column("text"), SLICE_BYTES):
            n = len(part)
            (a, b), (n_a, n_b) = tools.encode(part.to_pylist())
            # ends run on from text to text, so that one merge serves the slice
            i, j = common_ends(np.cumsum(tools.sizes[0][a]), np.cumsum(tools.sizes[1][b]))
            first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
            row = np.repeat(np.arange(n), n_a)[i]
            n_groups = np.bincount(row, minlength=n)
            columns = [_lists(a, n_a), _lists(b, n_b), _lists(i + 1 - first_a[row], n_groups), _lists(j + 1 - first_b[row], n_groups)]
            yield pa.record_batch(
                [batch.column(c).slice(start, n) for c in ("row", "id")] + columns, names=["row", "id", *NAMES]
            )


def align(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The token ids of each text by both tokenizers and the groups they form:
    ``row, id, a_ids, b_ids, a_cuts, b_cuts``, one row per row of ``docs``.

    A (a byte-level BPE file) reads a space and the text, B (a piece model, which
    adds the space) the text. Group g holds A's tokens up to ``a_cuts[g]`` and B's
    up to ``b_cuts[g]``, from those of the group before on. The paths are files that
    every executor has.

    Null and empty texts, and those whose bytes either tokenizer does not give
    back, have no tokens. Null and repeated ids are kept, row by row (``row`` is a
    number of its own for each); other columns are not looked at. Long texts are
    encoded in parts, but one text is one task's work.
    """
    return _texts(docs, id_col, text_col).mapInArrow(lambda b: aligned(b, a_path, b_path), ALIGNED_DDL)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    )


def decimals(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The decimal text of 0..n-1, a byte of room after each: text, starts, sizes."""
    texts = [f"{i} ".encode() for i in range(n)]
    sizes = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes


def written(tools: Pair, a, b, a_end, b_end) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` as bytes, and where the text of each group ends."""
    groups = len(a_end)
    a_size, b_size = np.diff(a_end, prepend=0), np.diff(b_end, prepend=0)
    place_a = np.arange(len(a)) + np.repeat(b_end - b_size, a_size)
    place_b = np.arange(len(b)) + np.repeat(a_end, b_size)
    starts, sizes = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.int64)
    marks = np.full(len(starts), ord(","), np.uint8)
    shift = len(tools.digits[0][0])
    for place, ids, k in ((place_a, a, 0), (place_b, b, 1)):
        _, at, n = tools.digits[k]
        starts[place], sizes[place] = at[ids] + k * shift, n[ids]
    marks[place_a[a_end - 1]] = ord("|")
    marks[place_b[b_end - 1]] = ord(";")
    text = gathered(np.append(tools.digits[0][0], tools.digits[1][0]), starts, sizes)
    ends = np.cumsum(sizes)
    text[ends - 1] = marks
    return text, ends[place_b[b_end - 1]] if groups else np.zeros(0, np.int64)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of lists, and where each list begins and ends among them."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


PROFILE_DDL = "row long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def profiled(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    """What aligned texts add up to: counts, a digest of the groups, and the linked
    id pairs with the times each occurs."""
    tools = pair(a_path, b_path)
    for batch in batches:
        n = len(batch)
        (a, at_a), (b, at_b), (cut_a, at_g), (cut_b, _) = (_flat(batch.column(c)) for c in NAMES)
        row = np.repeat(np.arange(n), np.diff(at_g))
        # (both tokens of a link end with their group)
        end_a, end_b = cut_a + at_a[row], cut_b + at_b[row]
        sums = [hashlib.sha256() for _ in range(n)]
        for lo in range(0, len(row), GROUPS):
            hi = min(lo + GROUPS, len(row))
            a0, b0 = (end_a[lo - 1], end_b[lo - 1]) if lo else (0, 0)
            text, ends = written(tools, a[a0 : end_a[hi - 1]], b[b0 : end_b[hi - 1]], end_a[lo:hi] - a0, end_b[lo:hi] - b0)
            view, before = memoryview(text), 0
            for r in np.unique(row[lo:hi]):
                last = min(at_g[r + 1], hi) - 1
                stop = int(ends[last - lo])
                # nothing follows the last group
                sums[r].update(view[before : stop - (last == at_g[r + 1] - 1)])
                before = stop
        key = (a[end_a - 1].astype(np.int64) << ID_BITS) | b[end_b - 1]
        order = np.lexsort((key, row))
        key, owner = key[order], row[order]
        new = np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])) if len(key) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        pairs = np.append(0, np.cumsum(np.bincount(owner[first], minlength=n))).astype(np.int32)
        groups = np.diff(at_g)
        yield pa.record_batch(
            [
                batch.column("row"),
                batch.column("id"),
                pa.array(np.diff(at_a)),
                pa.array(np.diff(at_b)),
                pa.array(groups),
                pa.array(groups),
                pa.array([s.hexdigest() if g else "" for s, g in zip(sums, groups, strict=True)]),
                pa.ListArray.from_arrays(pa.array(pairs), pa.array(key[first])),
                pa.ListArray.from_arrays(pa.array(pairs), pa.array(np.diff(np.append(first, len(key))).astype(np.int32))),
            ],
            schema=PROFILE,
        )


PROFILE = pa.schema(
    [(c, pa.int64()) for c in ("row", "id", "n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))]
)


def added_up(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Pairs and their counts, added up as far as ``most`` pairs go."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        more = [batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pairs", "times")]
        keys, place = np.unique(np.append(keys, more[0]), return_inverse=True)
        counts = np.bincount(place, weights=np.append(counts, more[1]), minlength=len(keys)).astype(np.int64)
        if len(keys) > most:
            yield pa.record_batch([keys, counts], names=["pair", "n"])
            keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    yield pa.record_batch([keys, counts], names=["pair", "n"])


def link_counts(profile: DataFrame) -> DataFrame:
    """``pair, n, best``: how many links of the corpus join the two ids, and whether
    no pair with the same B id has more. (``pair`` is A's id and, in the last 24
    bits, B's.)"""
    added = profile.select("pairs", "times").mapInArrow(added_up, "pair long, n long")
    counts = stage(added.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND((1 << ID_BITS) - 1)
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    joined = counts.withColumn("b", b).join(most, "b")
    return joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def popular(counts: DataFrame, most: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """A number of links from which on there are at most ``most`` pairs, and those
    pairs, sorted, with their counts and whether they are best."""
    # (steps of an eighth of an octave: a few hundred rows)
    step = F.floor(8 * F.log2("n"))
    steps = counts.groupBy(step.alias("step")).agg(F.min("n").alias("least"), F.count("*").alias("pairs")).collect()
    limit, held = (1 << 62), 0
    for r in sorted(steps, key=lambda r: -r["step"]):
        held += r["pairs"]
        if held > most:
            break
        limit = r["least"]
    found = counts.where(F.col("n") >= limit).select("pair", "n", "best").toArrow().combine_chunks().sort_by("pair")
    return limit, *(found.column(c).to_numpy() for c in ("pair", "n", "best"))


LOOKED_DDL = "row long, known_best long, known_sum long, pairs array<long>, times array<int>"


def looked_up(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Sums over the popular pairs of every text, and the pairs that are not."""
    known, counts, best = shared.value
    for batch in batches:
        (pairs, at), (times, _) = _flat(batch.column("pairs")), _flat(batch.column("times"))
        n, row = len(batch), np.repeat(np.arange(len(batch)), np.diff(at))
        hit = np.zeros(len(pairs), bool)
        totals = np.zeros((2, n), np.int64)
        if len(known):
            place = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
            hit = known[place] == pairs
            place, r, t = place[hit], row[hit], times[hit].astype(np.int64)
            np.add.at(totals[0], r, t * best[place])
            np.add.at(totals[1], r, t * counts[place])
        offsets = pa.array(np.append(0, np.cumsum(np.bincount(row[~hit], minlength=n))).astype(np.int32))
        yield pa.record_batch(
            [
                batch.column("row"),
                *map(pa.array, totals),
                pa.ListArray.from_arrays(offsets, pa.array(pairs[~hit])),
                pa.ListArray.from_arrays(offsets, pa.array(times[~hit])),
            ],
            names=["row", "known_best", "known_sum", "pairs", "times"],
        )


def link_profile(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    most: int = POPULAR,
) -> DataFrame:
    """How the texts align, and how usual their links are in all texts: ``doc_id,
    n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A link is an A and a B token that end together, one in every group. The count
    of an id pair is its number of links in all texts; ``count_sum`` adds it up over
    the text's links, ``n_best`` counts the links whose pair has the highest count of
    its B id. Counts of the ``most`` popular pairs are sent to every task; links of
    the rarer ones, which are few, are joined. Texts as in :func:`align`; without
    tokens all is 0 and the digest empty.
    """
    texts = _texts(docs, id_col, text_col)
    run = texts.mapInArrow(lambda b: profiled(aligned(b, a_path, b_path), a_path, b_path), PROFILE_DDL)
    profile = stage(run, "profile")
    counts = stage(link_counts(profile), "link-counts")
    limit, *table = popular(counts, most)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(table))
    looked = stage(profile.select("row", "pairs", "times").mapInArrow(lambda b: looked_up(b, shared), LOOKED_DDL), "looked")
    rare = looked.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnsRenamed({"pairs": "pair", "times": "links"})
    rare = rare.join(counts.where(F.col("n") < limit), "pair").groupBy("row")
    rare = rare.agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("rare_best"),
        F.sum(F.col("n") * F.col("links")).alias("rare_sum"),
    )
    sums = looked.drop("pairs", "times").join(rare, "row", "left")
    total = {c: F.col(f"known_{c}") + F.coalesce(f"rare_{c}", F.lit(0)) for c in ("best", "sum")}
    return profile.drop("pairs", "times").join(sums, "row").select(
        F.col("id").alias("doc_id"),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        total["best"].cast("long").alias("n_best"),
        total["sum"].cast("long").alias("count_sum"),
        "groups_sha256",
    )
