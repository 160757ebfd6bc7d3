"""Secrets in text: fixed patterns, and strings that look random.

Only DataFrame functions. Strings of letters, digits and a few signs are judged
by two Markov models of character pairs, one of secrets and one of ordinary
identifiers: the sum of log-likelihood ratios tells them apart. The models are
counted from labelled samples; by default what the patterns find in the
documents, and the long strings they do not touch.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitwx.session import stage

# The kinds of base spans in their order, with pattern, group whose
# length counts, and the least length.
BASE = (
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
RANDOM = "random"
#: Strings that the models judge.
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
#: Least log-likelihood ratio (natural log) of a secret.
MARGIN = 10.0

SPAN = "array<struct<start:int,end:int,token:string>>"


#: Entries of a list that are added up one by one; lists of more are cut in blocks.
BLOCK = 256


def bound(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def before_each(values: Column, zero: int, step) -> Column:
    """For every entry of an integer array what ``step`` makes of those before it.
    (A growing list is copied at every entry, so long ones are done in blocks.)"""
    none = F.array().cast("array<int>")

    def run(part: Column, start: Column) -> Column:
        first = F.struct(start.alias("at"), none.alias("list"))
        return F.aggregate(
            part,
            first,
            lambda s, x: F.struct(step(s["at"], x).alias("at"), F.concat(s["list"], F.array(s["at"])).alias("list")),
            lambda s: s["list"],
        )

    def blocks(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(v) / BLOCK).cast("int"), F.lit(1)) - 1)
        part = lambda i: F.slice(v, i * BLOCK + 1, BLOCK)
        totals = F.transform(numbers, lambda i: F.aggregate(part(i), F.lit(zero), step))
        starts = run(totals, F.lit(zero))
        return bound(starts, lambda s: F.flatten(F.transform(numbers, lambda i: run(part(i), F.element_at(s, i + 1)))))

    return bound(values, blocks)


def spans(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches as ``(start, end, token)``, in code
    points; ``token`` is the group. The pieces between the matches give the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tokens = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    parts = F.arrays_zip(gaps.alias("g"), F.transform(found, F.length).alias("m"), tokens.alias("t"))

    def placed(parts: Column) -> Column:
        # (the last gap has no match after it)
        lengths = F.transform(parts, lambda x: x["g"] + F.coalesce(x["m"], F.lit(0)))
        starts = before_each(lengths, 0, lambda a, b: a + b)
        rows = F.arrays_zip(starts.alias("s"), parts.alias("p"))
        joined = F.transform(
            F.filter(rows, lambda x: x["p"]["m"].isNotNull()),
            lambda x: F.struct(
                (x["s"] + x["p"]["g"]).alias("start"),
                (x["s"] + x["p"]["g"] + x["p"]["m"]).alias("end"),
                x["p"]["t"].alias("token"),
            ),
        )
        return joined

    return F.when(text.rlike(pattern), bound(parts, placed)).otherwise(F.array().cast(SPAN))


def outside(candidates: Column, base: Column) -> Column:
    """The candidates that no base span overlaps. Both are sorted together; the
    largest end of base spans before a candidate and the smallest start of those
    after it decide."""
    far = 1 << 30

    def event(kind: int):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"), s["token"].alias("token"))

    def judged(events: Column) -> Column:
        ends = F.transform(events, lambda e: F.when(e["kind"] == 0, e["end"]).otherwise(0))
        starts = F.reverse(F.transform(events, lambda e: F.when(e["kind"] == 0, e["start"]).otherwise(far)))
        left = before_each(ends, 0, lambda a, b: F.greatest(a, b))
        right = F.reverse(before_each(starts, far, lambda a, b: F.least(a, b)))
        rows = F.arrays_zip(events.alias("e"), left.alias("l"), right.alias("r"))
        clear = lambda x: (x["e"]["kind"] == 1) & (x["l"] <= x["e"]["start"]) & (x["r"] >= x["e"]["end"])
        return F.transform(F.filter(rows, clear), lambda x: F.struct(x["e"]["start"].alias("start"), x["e"]["end"].alias("end"), x["e"]["token"].alias("token")))

    events = F.array_sort(F.concat(F.transform(base, event(0)), F.transform(candidates, event(1))))
    both = (F.size(candidates) > 0) & (F.size(base) > 0)
    return F.when(both, bound(events, judged)).otherwise(candidates)


def long_enough(found: Column, least: int) -> Column:
    return F.filter(found, lambda s: F.length(s["token"]) >= least)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the spans of every base kind and the strings to be judged."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = [long_enough(spans(text, pattern, group), least).alias(kind) for kind, pattern, group, least in BASE]
    wide = docs.select(F.col(id_col).alias("doc_id"), *base, spans(text, CANDIDATE).alias("candidates"))
    all_base = F.concat(*(F.col(kind) for kind, *_ in BASE))
    return wide.withColumn("candidates", outside(F.col("candidates"), all_base))


def labelled(scanned: DataFrame) -> DataFrame:
    """``(token, secret)``: what the base patterns found, and the other strings."""
    found = F.transform(F.concat(*(F.col(kind) for kind, *_ in BASE)), lambda s: s["token"])
    other = F.transform("candidates", lambda s: s["token"])
    return scanned.select(F.explode(found).alias("token"), F.lit(True).alias("secret")).union(
        scanned.select(F.explode(other).alias("token"), F.lit(False).alias("secret"))
    )


def codes(token: Column) -> Column:
    """Places of the characters in the alphabet; others are left out."""
    each = F.transform(F.split(token, ""), lambda c: F.when(c == "", 0).otherwise(F.position(c, F.lit(ALPHABET))))
    return F.filter(each, lambda i: i > 0)


def pair_counts(samples: DataFrame) -> DataFrame:
    """How often each pair of characters occurs in distinct tokens, by class."""
    row = samples.select("token", "secret").na.drop().distinct().withColumn("codes", codes(F.col("token")))
    n = F.size("codes")
    pairs = F.transform(
        F.sequence(F.lit(1), n - 1), lambda i: F.element_at("codes", i) * 100 + F.element_at("codes", i + 1)
    )
    return row.where(n > 1).select("secret", F.explode(pairs).alias("pair")).groupBy("secret", "pair").count()


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of every pair of characters, row by row of the
    alphabet, from ``(token, secret)`` rows; one more of each pair than counted.

    The counts come to the driver: at most two per pair of the fixed alphabet.
    """
    size = len(ALPHABET)
    seen = {s: [[1] * size for _ in range(size)] for s in (True, False)}
    for r in pair_counts(samples).collect():
        seen[r["secret"]][r["pair"] // 100 - 1][r["pair"] % 100 - 1] += r["count"]
    out = []
    for i in range(size):
        totals = {s: sum(seen[s][i]) for s in seen}
        out += [log(seen[True][i][j] / totals[True]) - log(seen[False][i][j] / totals[False]) for j in range(size)]
    return out


def ratio(token: Column, model: list[float]) -> Column:
    """The log-likelihood ratio of a token."""
    table = F.expr("array(" + ",".join(f"{v:.6f}D" for v in model) + ")")
    size = len(ALPHABET)
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("last"))
    return F.aggregate(
        codes(token),
        start,
        lambda s, c: F.struct(
            (s["sum"] + F.when(s["last"] > 0, F.element_at(table, (s["last"] - 1) * size + c)).otherwise(F.lit(0.0))).alias("sum"),
            c.alias("last"),
        ),
        lambda s: s["sum"],
    )


def find_secrets(
    docs: DataFrame, samples: DataFrame | None = None, margin: float = MARGIN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, one array of ``(start, end, token)`` for
    each base kind, and ``random`` for strings outside those spans whose ratio
    exceeds ``margin``.

    ``samples`` has ``token`` and ``secret`` (boolean); without it the documents
    label themselves, see ``labelled``. Without a sample of both classes a ratio
    means nothing and no random span is added. Null texts count as empty; repeated
    rows give equal rows; an empty table gives an empty result.
    """
    scanned = stage(scan(docs, id_col, text_col), "scanned")
    samples = labelled(scanned) if samples is None else samples
    both = samples.agg(F.count_if("secret"), F.count_if(~F.col("secret"))).first()
    model = train(samples) if both[0] and both[1] else [0.0] * len(ALPHABET) ** 2
    added = F.filter("candidates", lambda c: ratio(c["token"], model) > margin)
    return scanned.select("doc_id", *(kind for kind, *_ in BASE), added.alias(RANDOM))


def ranked(n: int, kind: str):
    return lambda s: F.struct(s["start"].alias("s"), F.lit(n).alias("n"), s["end"].alias("e"), F.lit(kind).alias("k"))


def listed(kinds: list[str]) -> Column:
    """``kind:start:end`` of the named kinds, by start and then kind, comma-joined."""
    parts = [F.transform(kind, ranked(n, kind)) for n, kind in enumerate(kinds)]
    rows = F.array_sort(F.concat(*parts))
    return F.array_join(F.transform(rows, lambda r: F.concat_ws(":", r["k"], r["s"], r["e"])), ",")
