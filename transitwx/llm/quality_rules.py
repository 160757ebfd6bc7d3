"""Quality rules as a ledger of bits.

Every rule is evaluated once per text. The ledger keeps what was measured and one
bit per rule that the text fails. A policy is a set of rules, so a mask of bits:
which texts it keeps, what another version of it would keep and what each of its
rules removes alone are bit operations on the ledger, without reading a text again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitwx.llm.tokens import Words, plain_table, slices, valid_windows, windows, words_of

#: Consecutive words that count as a repetition when found twice.
REPEAT = 3
SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_letter_words",
)


@dataclass(frozen=True)
class Rule:
    """A bit of the ledger and the condition, over measures, that sets it."""

    name: str
    bit: int
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


RULES = (
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("short_words", 2, "word_chars < 2 * n_words"),
    Rule("long_words", 3, "word_chars > 20 * n_words"),
    Rule("symbols", 4, "100 * n_symbols > 10 * word_chars"),
    Rule("repeated_lines", 5, "100 * n_dup_lines > 60 * n_lines"),
    Rule("few_letters", 6, "100 * n_letter_words < 40 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A version of the names of rules that a text has to pass."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        bits = {r.name: r.mask for r in rules}
        return sum(bits[n] for n in set(self.rules))


BASE = Policy("base", ("few_words", "repeated_words"))
#: Every later version has the rules of the base.
CURRENT = Policy("2", tuple(r.name for r in RULES))
POLICIES = (BASE, Policy("1", (*BASE.rules, "short_words", "long_words", "symbols")), CURRENT)


def repeated(words: Words, size: int = REPEAT) -> np.ndarray:
    """Whether each word lies in a window that its row holds twice or more."""
    covered = np.zeros(len(words.row), bool)
    at = np.flatnonzero(valid_windows(words, size))
    if not len(at):
        return covered
    row, h, check = words.row[at], windows(words, size, 0)[at], windows(words, size, 1)[at]
    # windows met twice anywhere in the slice are few; of those, the whole key decides
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    twice = order[np.append(same, False) | np.append(False, same)]
    order = twice[np.lexsort((check[twice], h[twice], row[twice]))]
    r, a, b = row[order], h[order], check[order]
    same = (r[1:] == r[:-1]) & (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    found = at[order[np.append(same, False) | np.append(False, same)]] if len(order) else order
    for i in range(size):
        covered[found + i] = True
    return covered


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flags, dtype=np.int64))
    return total[bounds[1:]] - total[bounds[:-1]]


#: Byte classes: begins a character of a word; a symbol; a letter or part of a wider character.
_WORD = np.array([not (0x80 <= b < 0xC0) and b not in SPACES.encode() for b in range(256)])
_SYMBOL = np.array([b in SYMBOLS for b in range(256)])
_LETTER = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The measures of every text."""
    for batch in batches:
        ids = batch.column("id")
        for start, part in slices(batch.column("text")):
            n = len(part)
            words = words_of(part, plain_table(), 2)
            offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + n + 1]
            held = part.buffers()[2]
            raw = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
            bounds = offsets - offsets[0]
            letters = np.append(0, np.cumsum(_LETTER[raw], dtype=np.int64))
            lettered = letters[words.end] > letters[words.start]
            lines = np.zeros((n, 2), np.int64)
            for i, text in enumerate(part.to_pylist()):
                if "\n" in text:
                    full = [x for x in text.split("\n") if x.strip(SPACES)]
                    lines[i] = len(full), len(full) - len(set(full))
                else:
                    lines[i, 0] = words.first[i + 1] > words.first[i]
            values = {
                "n_words": np.diff(words.first),
                "word_chars": _per_row(_WORD[raw], bounds),
                "n_symbols": _per_row(_SYMBOL[raw], bounds),
                "n_dup_lines": lines[:, 1],
                "n_repeat_words": _per_row(repeated(words), words.first),
                "n_lines": lines[:, 0],
                "n_letter_words": _per_row(lettered, words.first),
            }
            columns = [pa.array(values[m].astype(np.int64)) for m in MEASURES]
            yield pa.record_batch([ids.slice(start, n), *columns], names=["doc_id", *MEASURES])


def failed_bits(rules: Sequence[Rule]) -> Column:
    """All bits of the rules whose condition holds."""
    bits = [F.when(F.expr(r.fails), F.lit(r.mask)).otherwise(F.lit(0)).cast("long") for r in rules]
    total = F.lit(0).cast("long")
    for b in bits:
        total = total.bitwiseOR(b)
    return total


def ledger(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the measures and ``failed``, the bits
    of the rules it fails.

    Words are runs of anything but space and 0x09-0x0D. ``word_chars`` counts the
    code points in words, ``n_symbols`` the characters ``#*$%&|<>``, ``n_lines`` the
    lines with a word, ``n_dup_lines`` those equal to an earlier line of the text,
    ``n_repeat_words`` the words in runs of three that occur twice or more in the
    text (the first time included), ``n_letter_words`` the words with a letter.

    Null, empty and blank texts measure 0 everywhere. A null id stays null; rows
    that repeat an id are judged one by one; other columns are not looked at. An
    empty table gives an empty ledger. Texts are read whole, one at a time.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ddl = ", ".join(["doc_id long", *(f"{m} long" for m in MEASURES)])
    return texts.mapInArrow(measured, ddl).withColumn("failed", failed_bits(rules))


def passes(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """Whether a row of the ledger passes all rules of the policy."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask(rules))) == 0


def ablation(entries: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per policy and rule of it: texts and words in all, texts and words the
    policy keeps, texts the rule fails, and what would be kept without the rule.

    The ledger is reduced to counts per distinct set of bits first (as many as
    sets occur); policies are worked out on those. An empty ledger gives no rows.
    """
    counts = entries.groupBy("failed").agg(F.count("*").alias("texts"), F.sum("n_words").alias("words"))
    named = [
        F.struct(
            F.lit(p.version).alias("policy"),
            F.lit(r.name).alias("rule"),
            F.lit(p.mask(rules)).cast("long").alias("mask"),
            F.lit(r.mask).cast("long").alias("bit"),
        )
        for p in policies
        for r in rules
        if r.name in p.rules
    ]
    rows = counts.select("*", F.inline(F.array(*named)))
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    alone = (hit == 0) | (hit == F.col("bit"))

    def total(condition: Column, what: str) -> Column:
        return F.sum(F.when(condition, F.col(what)).otherwise(0)).alias

    return rows.groupBy("policy", "rule").agg(
        F.sum("texts").alias("texts"),
        F.sum("words").alias("words"),
        total(hit == 0, "texts")("kept_texts"),
        total(hit == 0, "words")("kept_words"),
        total(F.col("failed").bitwiseAND(F.col("bit")) != 0, "texts")("failed_texts"),
        total(alone, "texts")("kept_texts_without"),
        total(alone, "words")("kept_words_without"),
    )
