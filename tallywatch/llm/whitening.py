"""Whitening of embeddings by QDWH spectral divide and conquer.

Vectors are put on a grid of whole numbers first, so counts, sums and squared
deviations are exact. The covariance of the distinct vectors is summed by tasks, each
adding up one matrix, and only that matrix (its size is that of the dimension, not of
the table) goes to the driver. There the polar factor of the covariance less a shift,
found by the dynamically weighted Halley iteration with QR steps, gives the projector
on the eigenvectors above the shift; the two invariant subspaces are split again until
every part is a single component. The components wanted, a few rows, then go to all
tasks, which project the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.session import pinned

GRID = 64  # steps of the grid in one unit
FAR = float(1 << 53)  # entries beyond that many steps are moved there
COMPONENTS = 16
NUMBERS = 4_000_000  # of vectors that a worker holds as a matrix at a time
MATRIX = 1 << 26  # entries of all covariances together that the driver takes
HALF = 26  # bits of the lower part of a sum
EPS = np.finfo(float).eps


# -- polar decomposition and splitting -----------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix: its eigenvalues' signs."""
    m = len(a)
    size = np.abs(a).sum(0).max()
    if size == 0:
        return np.eye(m)
    x, low, eye = a / size, EPS, np.eye(m)
    for _ in range(30):
        g = (4 * (1 - low**2) / low**4) ** (1 / 3)
        w = math.sqrt(1 + g) + math.sqrt(8 - 4 * g + 8 * (2 - low**2) / (low**2 * math.sqrt(1 + g))) / 2
        b = (w - 1) ** 2 / 4
        c = w + b - 1
        q, _ = np.linalg.qr(np.vstack([math.sqrt(c) * x, eye]))
        after = b / c * x + (w - b / c) / math.sqrt(c) * (q[:m] @ q[m:].T)
        after = (after + after.T) / 2
        low = min(1.0, low * (w + b * low**2) / (1 + c * low**2))
        moved = np.linalg.norm(after - x)
        x = after
        if moved < EPS ** (1 / 3) and 1 - low < 10 * EPS:
            break
    return x


def _shifts(a: np.ndarray) -> list[float]:
    """Where to split: inside the spectrum, first at the middle of the diagonal."""
    diagonal = np.sort(np.diag(a))
    mean, spread = diagonal.mean(), np.linalg.norm(a - np.eye(len(a)) * diagonal.mean())
    spread /= math.sqrt(len(a))
    return [float(np.median(diagonal)), mean, *(mean + spread * f for f in (0.3, -0.3, 0.1, -0.1, 0.7, -0.7))]


def split(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first k columns span the upper invariant subspace.

    None when all eigenvalues are the same to the last digits. A shift that meets an
    eigenvalue leaves the subspaces coupled; then another one is taken.
    """
    m, size = len(a), np.linalg.norm(a)
    if np.linalg.norm(a - np.eye(m) * np.trace(a) / m) <= 4 * EPS * size:
        return None
    best, coupled_best = None, np.inf
    for shift in _shifts(a):
        projector = (polar(a - shift * np.eye(m)) + np.eye(m)) / 2
        k = round(float(np.trace(projector)))
        if not 0 < k < m:
            continue
        start = np.random.default_rng(m).standard_normal((m, k))
        q, _ = np.linalg.qr(projector @ start)
        q, _ = np.linalg.qr(projector @ q, mode="complete")
        coupled = np.linalg.norm(q[:, k:].T @ a @ q[:, :k])
        if coupled < coupled_best:
            best, coupled_best = (q, k), coupled
        if coupled <= 2 * m * EPS * size:
            break
    return best


def components(a: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    m = len(a)
    most = m if most is None else min(most, m)
    parts = [(a, np.eye(m))]  # blocks still to split, the uppermost last
    values, vectors = [], []
    while parts and len(values) < most:
        block, basis = parts.pop()
        found = split(block) if len(block) > 1 else None
        if found is None:  # single, or the same in every direction
            values.extend(np.diag(block).tolist())
            vectors.extend(basis.T)
            continue
        q, k = found
        for part in (q[:, k:], q[:, :k]):
            inner = part.T @ block @ part
            parts.append(((inner + inner.T) / 2, basis @ part))
    order = np.argsort(-np.array(values), kind="stable")[:most]
    vectors = np.array(vectors).reshape(-1, m)[order].T
    return np.array(values)[order], vectors / np.linalg.norm(vectors, axis=0)


# -- the table ------------------------------------------------------------------------


@dataclass
class Fit:
    """What vectors of one length have in common."""

    n: int
    sums: list[int]
    values: np.ndarray  # of the components, falling
    vectors: np.ndarray  # components as columns
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(float) - part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n * x - sum)^2 of each row, exact; None beyond 64 bits."""
        rough = (self.centred(x) * self.n) ** 2
        if np.abs(x).max(initial=0) * float(self.n) < 2.0**61 and rough.sum(1).max(initial=0) < 2.0**62:
            return ((x * self.n - np.array(self.sums, np.int64)) ** 2).sum(1).tolist()
        out = [sum((v * self.n - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [d if d < 1 << 63 else None for d in out]


def on_grid(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, x`` of the rows whose vector has entries, all of them finite numbers."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    usable = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)

    def step(c):
        return F.floor(F.least(F.greatest(c.cast("double") * GRID, F.lit(-FAR)), F.lit(FAR)))

    return vectors.filter(usable).select(vec_id, F.transform(vector, step).alias("x"))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and vectors of the rows of each length, in parts of bounded size."""
    x = batch.column(batch.schema.get_field_index("x"))
    lengths = np.diff(x.offsets.to_numpy())
    flat = x.values.to_numpy(zero_copy_only=False)
    starts = x.offsets.to_numpy()[:-1]
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        step = max(1, NUMBERS // int(d))
        for low in range(0, len(at), step):
            rows = at[low : low + step]
            yield rows, flat[starts[rows][:, None] + np.arange(d)]


def _sums(listed: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Rows and sums of each dimension, by length of the vectors."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, list] = {}
        for batch in batches:
            for rows, x in _matrices(batch):
                # two halves, each far from overflow whatever the number of rows
                halves = np.array([(x >> HALF).sum(0), (x & ((1 << HALF) - 1)).sum(0)])
                seen = have.setdefault(x.shape[1], [0, 0])
                seen[0] += len(rows)
                seen[1] = seen[1] + halves
        for d, (n, (high, low)) in have.items():
            columns = [np.full(d, d), np.arange(d), np.full(d, n), high, low]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in columns], names=["d", "i", "n", "high", "low"]
            )

    parts = listed.mapInArrow(added, "d long, i long, n long, high long, low long")
    sums = parts.groupBy("d", "i").agg(F.sum("n"), F.sum("high"), F.sum("low"))
    out: dict[int, tuple[int, list[int]]] = {}
    for d, i, n, high, low in sums.collect():  # one row for each dimension
        n, held = out.setdefault(d, (n, [0] * d))
        held[i] = (high << HALF) + low
    return out


def _products(listed: DataFrame, fits: dict[int, Fit], white: bool) -> dict[int, np.ndarray]:
    """Covariance of the centred, or of the whitened vectors, by length."""
    shared = listed.sparkSession.sparkContext.broadcast(fits)

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _matrices(batch):
                fit = shared.value[x.shape[1]]
                y = fit.whitened(x) if white else fit.centred(x)
                have[x.shape[1]] = have.get(x.shape[1], 0) + y.T @ y
        for d, product in have.items():
            i, j = np.triu_indices(len(product))
            columns = [pa.array(np.full(len(i), d)), pa.array(i), pa.array(j), pa.array(product[i, j])]
            yield pa.RecordBatch.from_arrays(columns, names=["d", "i", "j", "v"])

    parts = listed.mapInArrow(multiplied, "d long, i long, j long, v double")
    out: dict[int, np.ndarray] = {}
    for d, i, j, v in parts.groupBy("d", "i", "j").agg(F.sum("v")).collect():
        size = fits[d].vectors.shape[1] if white else d
        held = out.setdefault(d, np.zeros((size, size)))
        held[i, j] = held[j, i] = v / fits[d].n
    return out


def fit(gridded: DataFrame, most: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of each length of vectors in ``gridded`` (x); equal vectors count once."""
    listed = pinned(gridded.select("x").distinct(), "distinct-vectors")
    sums = _sums(listed)
    if sum(d * d for d in sums) > MATRIX:
        raise ValueError(f"covariances of more than {MATRIX} entries: {sorted(sums)} dimensions")
    fits = {d: Fit(n, s, np.zeros(0), np.zeros((d, 0)), 0.0) for d, (n, s) in sums.items()}
    for d, covariance in _products(listed, fits, white=False).items():
        values, vectors = components(covariance, most)
        real = values > d * EPS * values.max(initial=0)  # no variance is no component
        fits[d].values, fits[d].vectors = values[real], vectors[:, real]
        fits[d].trace = float(np.trace(covariance))
    for d, identity in _products(listed, fits, white=True).items():
        if len(identity):
            fits[d].identity_error = float(np.abs(identity - np.eye(len(identity))).max())
    return fits


def whiten(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS
) -> DataFrame:
    """Each usable row projected on the ``most`` largest components, one row for each.

    Returns ``vec_id``, ``component`` (from 1, by falling variance), ``n`` (distinct
    vectors), ``deviation``, ``whitened``, ``explained`` (share of all variance) and
    ``identity_error``. Entries count in whole steps of 1/64, rounded down; a constant
    added to all of them changes nothing here and is left out.

    Rows whose vector is null, empty, or has an entry that is null or not finite take
    no part. Vectors of each length are a fit of their own. Repeated rows are whitened
    each, but count once in the fit; a null id stays. Directions without variance (to
    the last digits) are no components, so a table of equal vectors, or an empty one,
    gives no rows. Entries beyond 2^53 steps count as 2^53 steps; a deviation that 64
    bits cannot hold is null. Other columns are not looked at. Covariances of more than
    2^26 entries together are an error: the driver holds them.
    """
    rows = on_grid(vectors, vec_id, vector)
    shared = vectors.sparkSession.sparkContext.broadcast(fit(rows, most))
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _matrices(batch):
                model = shared.value[x.shape[1]]
                k = len(model.values)
                if not k:
                    continue
                white = model.whitened(x)
                columns = [
                    batch.column(0).take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(x) * k, model.n), pa.int64()),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(white.ravel()),
                    pa.array(np.tile(model.values / model.trace, len(x))),
                    pa.array(np.full(len(x) * k, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[vec_id, *names])

    kinds = [T.IntegerType(), T.LongType(), T.LongType(), *[T.DoubleType()] * 3]
    schema = T.StructType([rows.schema[vec_id], *(T.StructField(n, k) for n, k in zip(names, kinds))])
    return rows.mapInArrow(projected, schema)
