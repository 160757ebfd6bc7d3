"""Whitening of embeddings by Jacobi-Davidson.

The leading eigenvectors of the vectors' covariance are found without forming it:
all the method needs is the covariance times a few columns, which is one pass over
the vectors (every task adds up its centred products). A search space is refined
by Rayleigh-Ritz; each Ritz vector not yet exact is corrected by the approximate
solution of the projected correction equation, MINRES steps taken for all of them
at once so that they share their passes; exact ones are locked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitwx.session import stage

#: Components asked for.
COMPONENTS = 32
#: ``x = floor(SCALE * c) + SHIFT``.
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this, once scaled, count as this.
LARGEST = 1 << 52
#: More columns than wanted in the block: they keep near values apart.
GUARD = 8
INNER_STEPS = 6
OUTER_STEPS = 200
EPS = float(np.finfo(np.float64).eps)
#: Values of a chunk of vectors.
CHUNK = 1 << 20
SEED = 7


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, y`` with ``y = x - SHIFT``, without vectors that are null or hold a null
    or an entry that is not finite."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    # (a null vector or entry makes no condition true)
    kept = vectors.where(v.isNotNull() & F.coalesce(finite, F.lit(False)))
    limit = float(LARGEST)
    y = F.transform(v, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(limit)), F.lit(-limit))).cast("long"))
    return kept.select(F.col(id_col).cast("long").alias("id"), y.alias("y"))


def chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and rows of integers; a vector shorter than ``width`` ends in zeros."""
    rows = max(1, CHUNK // max(width, 1))
    for batch in batches:
        for lo in range(0, len(batch), rows):
            part = batch.slice(lo, rows)
            lists = part.column("y")
            sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            out = np.zeros((len(part), width), np.int64)
            out[np.arange(width)[None, :] < sizes[:, None]] = flat
            yield part.column("id"), out


def summed(table: DataFrame, width: int, cells: int, part: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """``part`` of all chunks added up cell by cell: one row a task, summed by Spark.
    What comes to the driver is ``cells`` numbers."""
    dtype = np.int64 if kind == "long" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, dtype)
        for _, y in chunks(batches, width):
            total += part(y)
        if total.any():
            yield pa.record_batch([pa.array([total.tolist()], pa.list_(pa.from_numpy_dtype(dtype)))], names=["part"])

    value = F.sum(F.col("value").cast("decimal(38,0)")) if kind == "long" else F.sum("value")
    rows = table.mapInArrow(run, f"part array<{kind}>").select(F.posexplode("part").alias("cell", "value"))
    found = rows.groupBy("cell").agg(value.alias("value")).collect()
    out = np.zeros(cells, object if kind == "long" else np.float64)
    for r in found:
        out[r["cell"]] = int(r["value"]) if kind == "long" else r["value"]
    return out


@dataclass
class Centre:
    """Row count and exact sums of ``y``; the mean as an integer and a rest."""

    n: int
    sums: list[int]

    def __post_init__(self):
        whole = [s // self.n for s in self.sums]
        self.whole = np.array(whole, np.int64)
        self.left = [s - self.n * w for s, w in zip(self.sums, whole, strict=True)]
        self.rest = np.array([v / self.n for v in self.left])

    def of(self, y: np.ndarray) -> np.ndarray:
        """Centred rows: exact integers and one rounding."""
        return (y - self.whole) - self.rest

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n * x - S) ** 2``; None where that is no 64-bit integer."""
        d = y - self.whole
        widest = (int(np.abs(d).max()) + 1) * self.n if d.size else 0
        if widest**2 * max(1, d.shape[1]) < 1 << 63:
            return ((self.n * d - np.array(self.left, np.int64)) ** 2).sum(axis=1).tolist()
        exact = self.n * d.astype(object) - np.array(self.left, object)
        totals = (exact**2).sum(axis=1)
        return [int(t) if t < 1 << 63 else None for t in totals]


def centre(table: DataFrame) -> tuple[int, Centre | None]:
    """The longest vector's length, and the sums."""
    found = table.agg(F.count("*").alias("n"), F.max(F.size("y")).alias("width")).first()
    if not found["n"]:
        return 0, None
    width, bits = found["width"], 20

    def sums(y: np.ndarray) -> np.ndarray:
        # high and low bits apart, so that no sum overflows
        return np.append((y >> bits).sum(axis=0), (y & ((1 << bits) - 1)).sum(axis=0))

    cells = summed(table, width, 2 * width, sums, "long")
    return width, Centre(found["n"], [int(h) * (1 << bits) + int(low) for h, low in zip(cells[:width], cells[width:], strict=True)])


Product = Callable[[np.ndarray], np.ndarray]


def covariance_product(table: DataFrame, width: int, at: Centre) -> Product:
    """The covariance times the columns of a matrix, in one pass over the vectors."""

    def product(columns: np.ndarray) -> np.ndarray:
        def part(y: np.ndarray) -> np.ndarray:
            z = at.of(y)
            return (z.T @ (z @ columns)).reshape(-1)

        cells = summed(table, width, columns.size, part, "double")
        return cells.reshape(columns.shape) / at.n

    return product


def orthonormal(columns: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to the space of ``against``."""
    out = columns / np.maximum(np.linalg.norm(columns, axis=0), np.finfo(np.float64).tiny)
    for _ in range(2):
        out = out - against @ (against.T @ out)
        q, r = np.linalg.qr(out)
        out = q[:, np.abs(np.diag(r)) > 1e-8] if out.shape[1] else out
    return out


def minres(apply: Product, right: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """MINRES steps for several systems at once; ``apply`` gets one column of each."""
    k = right.shape[1]
    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    start = beta.copy()
    v_old, v = np.zeros_like(right), right / np.where(beta > 0, beta, 1)
    w_old, w = np.zeros_like(right), np.zeros_like(right)
    eta, c_old, c, s_old, s = beta.copy(), np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    beta = np.zeros(k)
    open_ = start > 0
    for _ in range(steps):
        if not open_.any():
            break
        p = apply(v) - beta * v_old
        alpha = (v * p).sum(axis=0)
        p -= alpha * v
        after = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta
        r1 = np.hypot(delta, after)
        r2 = s * alpha + c_old * c * beta
        r3 = s_old * beta
        open_ = open_ & (r1 > 0)
        safe = np.where(r1 > 0, r1, 1)
        c_old, c, s_old, s = c, delta / safe, s, after / safe
        w_old, w = w, (v - r3 * w_old - r2 * w) / safe
        x += np.where(open_, c * eta, 0) * w
        eta = -s * eta
        open_ = open_ & (np.abs(eta) > tolerance * start) & (after > 0)
        v_old, v = v, p / np.where(after > 0, after, 1)
        beta = after
    return x


def jacobi_davidson(product: Product, size: int, wanted: int, inner: int = INNER_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and unit eigenvectors of a symmetric
    operator without negative eigenvalues, to double precision.

    A vector is locked when its residual is at most ``size * EPS`` times the
    largest value; locked ones are kept out of the search space. Raises if that
    is not reached.
    """
    wanted = min(wanted, size)
    locked, values = np.zeros((size, 0)), np.zeros(0)
    block = min(size, wanted + GUARD)
    rng = np.random.default_rng(SEED)
    space = orthonormal(rng.normal(size=(size, block)), locked)
    image = product(space)
    largest, best, stuck = 0.0, np.inf, 0
    for _ in range(OUTER_STEPS):
        h = space.T @ image
        theta, turn = np.linalg.eigh((h + h.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        # rounding must not let the space lean on locked vectors
        largest = max(largest, float(theta[0]) if len(theta) else 0.0)
        residual = image - space * theta
        residual -= locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        limit = size * EPS * largest
        missing = wanted - len(values)
        whole = space.shape[1] + len(values) == size
        worst = float(norms[:missing].max(initial=0.0))
        best, stuck = (worst, 0) if worst < best / 2 else (best, stuck + 1)
        # what rounding alone leaves when nothing is outside the space, or steps change nothing
        done = norms <= (100 * limit if whole or stuck >= 5 else limit)
        ready = int(np.argmin(np.append(done[:missing], False)))
        if ready:
            locked = np.append(locked, space[:, :ready], axis=1)
            values = np.append(values, theta[:ready])
            space, image, theta, residual = (a[..., ready:] for a in (space, image, theta, residual))
            best, stuck = np.inf, 0
        if len(values) == wanted:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        if whole or stuck >= 10:
            break
        head = min(wanted - len(values) + GUARD, space.shape[1])
        if space.shape[1] + head > min(size - len(values), 4 * block):
            keep = min(space.shape[1], 2 * block)
            if space.shape[1] + head > size - len(values):
                keep = space.shape[1]
            space, image = space[:, :keep], image[:, :keep]
        near, shift = np.append(locked, space[:, :head], axis=1), theta[:head]

        def projected(t: np.ndarray, near=near, shift=shift) -> np.ndarray:
            t = t - near @ (near.T @ t)
            t = product(t) - t * shift
            return t - near @ (near.T @ t)

        right = -residual[:, :head]
        right = right - near @ (near.T @ right)
        room = size - near.shape[1]
        step = minres(projected, right, min(inner, room), 0.1) if room > head else right
        more = orthonormal(np.append(step, right, axis=1) if room > head else step, np.append(locked, space, axis=1))
        more = more[:, : size - len(values) - space.shape[1]]
        if not more.shape[1]:
            more = orthonormal(rng.normal(size=(size, head)), np.append(locked, space, axis=1))
        space, image = np.append(space, more, axis=1), np.append(image, product(more), axis=1)
    raise RuntimeError(f"{len(values)} of {wanted} eigenvectors found; the worst residual left is {worst:g}")


@dataclass
class Whitening:
    """Components (columns of ``scaled`` are divided by the root of their value)."""

    centre: Centre
    width: int
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def scaled(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(table: DataFrame, wanted: int = COMPONENTS) -> Whitening | None:
    """Learn from all rows of a staged ``id, y`` table; None if nothing varies."""
    width, at = centre(table)
    if at is None or not width:
        return None
    trace = float(summed(table, width, width, lambda y: (at.of(y) ** 2).sum(axis=0), "double").sum()) / at.n
    if trace <= 0:
        return None
    values, vectors = jacobi_davidson(covariance_product(table, width, at), width, wanted)
    # directions without variance can't be whitened
    real = values > width * EPS * values[0] * 100
    return Whitening(at, width, values[real], vectors[:, real], trace)


def identity_error(table: DataFrame, model: Whitening) -> float:
    """Largest difference between the whitened vectors' covariance and the identity."""
    k = len(model.values)
    scaled, at, width = model.scaled, model.centre, model.width

    def part(y: np.ndarray) -> np.ndarray:
        w = at.of(y) @ scaled
        return np.append(w.sum(axis=0), (w.T @ w).reshape(-1))

    cells = summed(table, width, k + k * k, part, "double") / at.n
    mean, second = cells[:k], cells[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


WHITENED_DDL = "id long, n long, deviation long, whitened array<double>"


def whiten_rows(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    scaled, at = model.scaled, model.centre
    for ids, y in chunks(batches, model.width):
        w = at.of(y) @ scaled
        offsets = np.arange(len(w) + 1, dtype=np.int32) * scaled.shape[1]
        yield pa.record_batch(
            [
                ids,
                pa.array(np.full(len(w), at.n)),
                pa.array(at.deviations(y), pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.reshape(-1))),
            ],
            names=["id", "n", "deviation", "whitened"],
        )


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> tuple[DataFrame, Whitening | None, float | None]:
    """Whitened vectors (``id, n, deviation, whitened``), the components and the
    largest difference of the result's covariance from the identity.

    Entries are read as ``floor(64 * c) + 1000000``. Vectors that are null or hold
    null, NaN or infinite entries are left out everywhere. A vector shorter than
    the longest counts as ending in zeros; scaled entries beyond 2**52 count as
    2**52. ``deviation`` is exact, and null where it is no 64-bit integer. There
    are as many components as asked for, or as many as have a variance; if nothing
    varies, or the table is empty, there is no row. Null and repeated ids are kept
    as they are, row by row; other columns are not looked at.
    """
    table = stage(integer_vectors(vectors, id_col, vector_col), "vectors")
    model = fit(table, components)
    if model is None:
        return table.sparkSession.createDataFrame([], WHITENED_DDL), None, None
    error = identity_error(table, model)
    return table.mapInArrow(lambda b: whiten_rows(b, model), WHITENED_DDL), model, error


def component_rows(whitened: DataFrame, model: Whitening | None, error: float | None) -> DataFrame:
    """One row per vector and component, numbered from 1 by falling variance."""
    shares = [] if model is None else (model.values / model.trace).tolist()
    rows = whitened.select(
        F.col("id").alias("vec_id"), "n", "deviation", F.posexplode("whitened").alias("place", "whitened")
    )
    explained = F.element_at(F.array(*map(F.lit, shares)), F.col("place") + 1) if shares else F.lit(None).cast("double")
    return rows.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
