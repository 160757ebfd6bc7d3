"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one that also
holds what is particular to toxic text. Short windows of words are compressed
with both; the windows of a toxic text come out shorter with the second. A
logistic curve over the differences of a text, fitted on documents that the
dictionaries have not seen, gives a calibrated score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from math import log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitwx.llm.tokens import slices

#: Labelled documents per class that training reads at most, chosen by hash of the id.
SAMPLE = 2000
#: Words of a window.
WINDOW = 6
#: Bytes of ordinary and of toxic text in a dictionary.
ORDINARY_BYTES, TOXIC_BYTES = 4096, 4096
THRESHOLD = 0.3
WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def contexts(texts: Sequence[Sequence[str]]) -> tuple[Counter, int]:
    """For each word the number of different words before it; copies of a text add nothing."""
    pairs = {p for text in texts for p in zip(["", *text], text, strict=False)}
    return Counter(w for _, w in pairs), max(1, len(pairs))


def train_dictionaries(toxic: Sequence[Sequence[str]], ordinary: Sequence[Sequence[str]]) -> tuple[bytes, bytes]:
    """Contents of the toxic and of the ordinary dictionary.

    The ordinary one has the words with most contexts. The toxic one has these
    too, and before them the words whose share of contexts in toxic text is over
    four times that in ordinary text, by how surely that is no accident.
    """
    a, na = contexts(toxic)
    b, nb = contexts(ordinary)
    least = 8 + 0.03 * len(toxic)
    found = []
    for w, n in a.items():
        ratio = (n / na) / ((b[w] + 0.5) / nb)
        if n >= 3 and ratio > 4 and n * log(ratio) >= least:
            found.append((-n * log(ratio), w))

    def fill(ranked, limit):
        # the best stand last, where a match is cheapest
        out = b" "
        for w in ranked:
            if len(out) + len(w.encode()) >= limit:
                break
            out = b" " + w.encode() + out
        return out

    base = fill((w for w, _ in sorted(b.items(), key=lambda x: (-x[1], x[0]))), ORDINARY_BYTES)
    return fill((w for _, w in sorted(found)), TOXIC_BYTES) + base, base


@dataclass
class Model:
    """Dictionaries and curve; travels to the tasks as it is."""

    toxic: bytes
    ordinary: bytes
    weights: Sequence[float]
    intercept: float

    @cached_property
    def compressors(self):
        settings = zstandard.ZstdCompressionParameters(
            min_match=4,
            strategy=3,
            window_log=17,
            hash_log=14,
            chain_log=14,
            search_log=4,
            write_checksum=False,
            write_content_size=False,
            write_dict_id=False,
        )
        out = []
        for content in (self.toxic, self.ordinary):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=settings)
            out.append(zstandard.ZstdCompressor(dict_data=d, compression_params=settings))
        return out

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "compressors"}

    def features(self, text: str | None) -> np.ndarray:
        """Mean, largest and shares of the windows' differences in compressed length."""
        ws = words(text)
        toxic, ordinary = self.compressors
        gains = []
        for i in range(0, len(ws), WINDOW):
            piece = (" " + " ".join(ws[i : i + WINDOW]) + " ").encode()
            gains.append(len(ordinary.compress(piece)) - len(toxic.compress(piece)))
        if not gains:
            return np.zeros(6)
        g = np.array(gains, float)
        top = np.clip(g - 1, 0, None)
        return np.array([g.mean(), g.max(), (g >= 2).mean(), (g >= 4).mean(), top.mean(), np.log1p(top.sum())])

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ np.asarray(self.weights) + self.intercept, -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[list[float], float]:
    """Logistic regression by Newton steps; ``weight`` restores the shares of the classes."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    penalty = np.diag([ridge] * x.shape[1] + [1e-3])
    beta = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        grad = z.T @ (weight * (y - p)) - penalty @ beta
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + penalty, grad)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    w = beta[:-1] / scale
    return [float(v) for v in w], float(beta[-1] - w @ mean)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from labelled documents: at most ``sample`` of each class, those
    with the smallest hash of the id. Their words are the only thing learned from.

    An id with several labels is toxic if one says so; null labels and ids are
    ignored. Every other document calibrates the curve, the rest make the
    dictionaries. With no toxic or no ordinary example all texts get one score,
    the share of toxic labels (0.5 without any).
    """
    one = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).na.drop()
    one = one.groupBy("id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["count"] for r in one.groupBy("y").count().collect() if r["y"] in (0, 1)}
    order = F.xxhash64("id", F.lit("toxicity"))
    picked = [one.where(F.col("y") == y).orderBy(order, "id").limit(sample) for y in (0, 1)]
    # at most two times `sample` ids
    chosen = F.broadcast(picked[0].union(picked[1]))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id").collect()
    rows = sorted({(r["id"], r["y"], r["text"] or "") for r in rows})
    by = {y: [words(t) for _, label, t in rows if label == y] for y in (0, 1)}
    total = sum(counts.values())
    if not by[0] or not by[1]:
        share = counts.get(1, 0) / total if total else 0.5
        return Model(b" ", b" ", [0.0] * 6, log((share + 1e-6) / (1 - share + 1e-6)))
    small = min(map(len, by.values())) < 4
    toxic, ordinary = train_dictionaries(*(by[y] if small else by[y][::2] for y in (1, 0)))
    model = Model(toxic, ordinary, [0.0] * 6, 0.0)
    texts = {y: by[y] if small else by[y][1::2] for y in (0, 1)}
    x = np.array([model.features(" ".join(t)) for y in (0, 1) for t in texts[y]])
    y = np.repeat([0.0, 1.0], [len(texts[0]), len(texts[1])])
    weight = np.where(y == 1, counts[1] / len(texts[1]), counts[0] / len(texts[0])) * len(y) / total
    model.weights, model.intercept = fit_curve(x, y, weight)
    return model


SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, part in slices(batch.column("text")):
            x = np.array([model.features(t) for t in part.to_pylist()])
            yield pa.record_batch([batch.column("doc_id").slice(start, len(part)), pa.array(model.score(x))], schema=SCORES)


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row, from its whole text; repeated rows get
    equal scores, null, empty and word-less texts the score of no signal."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(lambda b: scores(b, model), "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` below the threshold, with their columns as they are."""

    def clean(batches):
        for batch in batches:
            text = batch.column(text_col)
            kept = [model.score(np.array([model.features(t) for t in part.to_pylist()])) < threshold for _, part in slices(text)]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(clean, docs.schema)
