"""Language of a text from averaged embeddings of hashed subwords.

Character runs of two to four letters, with word ends, are hashed into a table
of vectors; their mean goes through a linear softmax. Both are trained together
by stochastic gradient descent in numpy. For prediction vectors and softmax are
multiplied into one table, so that a text costs one lookup per subword.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitwx.llm.tokens import slices

SIZES = (2, 3, 4)
BUCKETS = 1 << 15
WIDTH = 16
#: Documents per language that training reads, by expectation.
SAMPLE = 400
#: Subwords drawn of a document in one step, and passes over the sample.
DRAWN, EPOCHS, BATCH, RATE = 150, 12, 32, 8.0
#: Languages at most: a label column with more is no language column.
MOST_LANGUAGES = 1000
#: Share of right answers on held-back documents that rejection lets through.
ACCEPT = 0.99
UNKNOWN = "und"

_letters = np.zeros(0, bool)


def code_points(text: str) -> np.ndarray:
    """Lower-case letters as code points, one 0 for every other character, 0 around."""
    global _letters
    if not len(_letters):
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    cp = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letters[cp], cp, np.uint32(0))


def subwords(cp: np.ndarray) -> list[np.ndarray]:
    """Table rows of the subwords of each size; runs that cross a word end are left out."""
    out = []
    letter = cp != 0
    for n in SIZES:
        m = len(cp) - n + 1
        if m <= 0:
            out.append(np.zeros(0, np.int64))
            continue
        h = np.full(m, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        inner = np.ones(m, bool)
        for i in range(n):
            h = (h ^ cp[i : i + m]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
            if 0 < i < n - 1:
                inner &= letter[i : i + m]
        ok = inner & (letter[:m] | letter[n - 1 :]) if n > 2 else letter[:m] | letter[1:]
        out.append((h[ok] & np.uint32(BUCKETS - 1)).astype(np.int64))
    return out


@dataclass
class Model:
    """Log-odds of every table row per language, and the calibration."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    heat: float = 1.0
    accept_from: float = 0.0

    def predict(self, text: str | None) -> tuple[str, float]:
        cp = code_points(text or "")
        if not len(self.languages) or not cp.any():
            return UNKNOWN, 0.0
        total, n = np.zeros(len(self.languages)), 0
        for rows in subwords(cp):
            for lo in range(0, len(rows), 1 << 20):
                total += self.table[rows[lo : lo + (1 << 20)]].sum(axis=0, dtype=np.float64)
            n += len(rows)
        z = (total / max(n, 1) + self.bias) * self.heat
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def fit(texts: list[str], langs: list[str], seed: int = 7) -> Model:
    """Train on labelled texts; every fifth is held back to calibrate."""
    languages = sorted(set(langs))
    rows = [np.concatenate(subwords(code_points(t))) for t in texts]
    usable = [i for i, r in enumerate(rows) if len(r)]
    if not usable:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    rng = np.random.default_rng(seed)
    y = np.array([languages.index(v) for v in langs])
    held = [i for n, i in enumerate(usable) if n % 5 == 4]
    seen = np.array([i for n, i in enumerate(usable) if n % 5 != 4])
    vectors = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    out, bias = np.zeros((WIDTH, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    steps = max(1, -(-len(seen) // BATCH)) * EPOCHS
    step = 0
    while step < steps:
        for part in np.array_split(rng.permutation(seen), max(1, -(-len(seen) // BATCH))):
            rate = RATE * (1 - step / steps)
            drawn = np.stack([rng.choice(rows[i], DRAWN) for i in part])
            mean = vectors[drawn].mean(axis=1)
            z = mean @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            p /= len(part)
            back = p @ out.T / DRAWN * rate
            out -= rate * mean.T @ p
            bias -= 0.1 * rate * p.sum(axis=0)
            np.subtract.at(vectors, drawn.reshape(-1), np.repeat(back, DRAWN, axis=0))
            step += 1
    model = Model(languages, (vectors @ out).astype(np.float32), bias.astype(np.float64))
    if held:
        z = np.array([model.table[rows[i]].mean(axis=0, dtype=np.float64) + model.bias for i in held])
        model.heat = calibrate(z, y[held])
        answers = [model.predict(texts[i]) for i in held]
        right = sorted(s for i, (v, s) in zip(held, answers, strict=True) if v == langs[i])
        model.accept_from = right[int(len(right) * (1 - ACCEPT))] if right else 1.0
    return model


def calibrate(z: np.ndarray, y: np.ndarray) -> float:
    """The factor on the logits with the least log loss on held-back texts."""
    heats = 2.0 ** np.arange(-3, 5, 0.25)

    def loss(heat):
        s = z * heat
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    return float(min(heats, key=loss))


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from rows with a language: about ``sample`` of each, by hash of the id."""
    known = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    counts = known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    if not counts:
        return fit([], [])
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, sample / r["count"])) for r in counts], "lang string, share double")
    place = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = known.join(F.broadcast(shares), "lang").where(place < F.col("share")).select("id", "lang", "text").collect()
    rows = sorted((r["id"] if r["id"] is not None else -1, r["lang"], r["text"] or "") for r in rows)
    return fit([r[2] for r in rows], [r[1] for r in rows])


ANSWER = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])


def answers(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, part in slices(batch.column("text")):
            found = [model.predict(t) for t in part.to_pylist()]
            langs, score = [f[0] for f in found], [f[1] for f in found]
            sure = [v != UNKNOWN and s >= model.accept_from for v, s in found]
            columns = [batch.column("doc_id").slice(start, len(part)), pa.array(langs), pa.array(score), pa.array(sure)]
            yield pa.record_batch(columns, schema=ANSWER)


def predict_language(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, accepted`` for every row, from its whole text.

    ``lang_pred`` is a learned language, or ``und`` with score 0 for a null text
    or one without a letter (or if nothing was learned). ``score`` is the
    calibrated probability; ``accepted`` is false where it is so low that only
    one in a hundred right answers lies there. Repeated rows get equal answers.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(lambda b: answers(b, model), "doc_id long, lang_pred string, score double, accepted boolean")
