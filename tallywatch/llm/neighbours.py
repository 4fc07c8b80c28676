"""Approximate nearest neighbours by learned partitions.

On a bounded sample the graph of nearest neighbours is cut into partitions of equal
size that part few neighbours, and a small classifier learns which partition a
vector belongs to. It places every row in its most probable partition and sends
each query to several; what lies there is ranked by the exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.llm.common import numbered, unit
from tallywatch.session import pinned

SAMPLE = 8192  # vectors that partitions and classifier are fitted on
PARTITIONS = 64
PART_SAMPLE = 96  # sampled vectors a partition has at least
REACH = 0.98  # share of the held-out neighbours that the partitions searched must hold
BLOCK = 2048  # candidates in a block
QUERIES = 512  # queries in a block


def usable(vector: str | Column) -> Column:
    """Not null, not all zero, no null or non-finite component."""
    v = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(x: np.ndarray, y: np.ndarray, k: int, same: bool) -> np.ndarray:
    """Places in ``y`` of the ``k`` rows nearest to each row of ``x``."""
    out = np.zeros((len(x), k), np.int64)
    squares = (y * y).sum(1)
    for low in range(0, len(x), 512):
        d = squares - 2 * (x[low : low + 512] @ y.T)
        if same:
            d[np.arange(len(d)), np.arange(low, low + len(d))] = np.inf
        out[low : low + 512] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def halves(x: np.ndarray, rows: np.ndarray, parts: int, out: np.ndarray, first: int) -> None:
    """Cuts ``rows`` along their main direction into ``parts`` of equal size."""
    if parts == 1:
        out[rows] = first
        return
    centred = x[rows] - x[rows].mean(0)
    direction = np.ones(x.shape[1]) / np.sqrt(x.shape[1])
    for _ in range(20):
        direction = centred.T @ (centred @ direction)
        direction /= np.linalg.norm(direction) + 1e-30
    order = rows[np.argsort(centred @ direction, kind="stable")]
    left = parts // 2
    cut = len(rows) * left // parts
    halves(x, order[:cut], left, out, first)
    halves(x, order[cut:], parts - left, out, first + left)


def partition_graph(
    x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 1.1, rounds: int = 12
) -> np.ndarray:
    """A partition for each node: few edges cut, no partition ``slack`` times the mean.

    Starts from equal cuts along main directions; nodes then move to the partition
    that most of their neighbours are in, those that gain most first, while it has room.
    """
    n = len(x)
    label = np.zeros(n, np.int64)
    halves(x, np.arange(n), parts, label, 0)
    u = np.repeat(np.arange(n), graph.shape[1])
    v = graph.ravel()
    u, v = np.concatenate([u, v]), np.concatenate([v, u])
    room = int(np.ceil(slack * n / parts))
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (u, label[v]), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), label]
        sizes = np.bincount(label, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < room:
                sizes[label[i]] -= 1
                sizes[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if not moved:
            break
    return label


@dataclass
class Router:
    """A classifier with one hidden layer: probabilities of the partitions."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    probes: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        z = (x - self.mean) / self.scale
        return np.maximum(z @ w1 + b1, 0) @ w2 + b2


def fit_router(
    x: np.ndarray, label: np.ndarray, parts: int, seed: int, hidden: int = 128, epochs: int = 40
) -> Router:
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = (x - mean) / scale
    w = [
        rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)),
        np.zeros(hidden),
        rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)),
        np.zeros(parts),
    ]
    m, s, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for low in range(0, len(z), 256):
            rows = order[low : low + 256]
            a = z[rows]
            h = np.maximum(a @ w[0] + w[1], 0)
            logit = h @ w[2] + w[3]
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), label[rows]] -= 1
            p /= len(rows)
            back = (p @ w[2].T) * (h > 0)
            grads = [a.T @ back, back.sum(0), h.T @ p, p.sum(0)]
            t += 1
            for i, g in enumerate(grads):
                g = g + 1e-4 * w[i]
                m[i] = 0.9 * m[i] + 0.1 * g
                s[i] = 0.999 * s[i] + 0.001 * g * g
                w[i] = w[i] - 3e-3 * (m[i] / (1 - 0.9**t)) / (
                    np.sqrt(s[i] / (1 - 0.999**t)) + 1e-8
                )
    return Router(mean, scale, w)


def fit(sample: np.ndarray, partitions: int, reach: float, k: int, seed: int) -> Router:
    """Partitions and classifier from the sample; ``probes`` so that held-out queries
    find ``reach`` of their neighbours."""
    rng = np.random.default_rng(seed)
    sample = sample[rng.permutation(len(sample))]
    held, x = sample[: len(sample) // 8], sample[len(sample) // 8 :]
    parts = max(1, min(partitions, len(x) // PART_SAMPLE))
    if parts == 1:
        dim = sample.shape[1]
        zeros = [np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)]
        return Router(np.zeros(dim), np.ones(dim), zeros, 1)
    near = min(k, len(x) - 1)
    label = partition_graph(x, nearest(x, x, near, same=True), parts)
    router = fit_router(x, label, parts, seed)
    placed = router.logits(x).argmax(1)
    goal = placed[nearest(held, x, near, same=False)]
    rank = np.argsort(np.argsort(-router.logits(held), axis=1, kind="stable"), axis=1)
    found = np.sort(np.take_along_axis(rank, goal, 1).ravel())
    router.probes = int(found[min(len(found) - 1, int(np.ceil(reach * len(found))))]) + 1
    return router


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of a matrix, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def route(vectors: DataFrame, router: Router, probes: int) -> DataFrame:
    """``row, id, vector`` with ``part``: a row for each of the most probable partitions."""

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            logits = router.logits(_matrix(batch.column("vector")))
            best = np.argsort(-logits, axis=1, kind="stable")[:, :probes]
            at = pa.array(np.repeat(np.arange(batch.num_rows), best.shape[1]))
            columns = [c.take(at) for c in batch.columns]
            columns.append(pa.array(best.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part"])

    return vectors.mapInArrow(routed, "row long, id long, vector array<double>, part int")


def _blocks(routed: DataFrame, size: int, prefix: str) -> DataFrame:
    """The vectors of a partition in blocks of about ``size``, a row for each block."""
    counts = routed.groupBy("part").agg(F.ceil(F.count("*") / size).cast("int").alias("n"))
    dealt = routed.join(counts, "part").withColumn(
        "block", F.pmod(F.xxhash64("row"), F.col("n"))
    )
    own = F.struct("row", "id", "vector")
    return dealt.groupBy("part", "block").agg(F.collect_list(own).alias(prefix)).drop("block")


def _search(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Each query's ``k`` nearest of each block it meets: ``q_row, query_id, vec_id, score``."""

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q, c = batch.column("q")[i].values, batch.column("c")[i].values
                q_row, q_id = (q.field(x).to_numpy() for x in ("row", "id"))
                c_row, c_id = (c.field(x).to_numpy() for x in ("row", "id"))
                x, y = _matrix(q.field("vector")), _matrix(c.field("vector"))
                squares = (y * y).sum(1)
                rough = squares - 2 * (x @ y.T)
                # rounding of the quick form, far from touching what it selects
                slack = 1e-9 * (squares.max() + (x * x).sum(1) + 1)
                out = []
                for j in range(len(x)):
                    row = rough[j]
                    row[c_row == q_row[j]] = np.inf
                    n = min(k, len(row) - 1)
                    limit = np.partition(row, n)[n] if n < len(row) - 1 else np.inf
                    at = np.flatnonzero((row <= limit + slack[j]) & (c_row != q_row[j]))
                    score = np.sqrt(((y[at] - x[j]) ** 2).sum(1))
                    best = np.lexsort((c_row[at], c_id[at], score))[:k]
                    out.append((np.full(len(best), j), at[best], score[best]))
                j, at, score = (np.concatenate(o) for o in zip(*out))
                columns = [pa.array(a) for a in (q_row[j], q_id[j], c_row[at], c_id[at], score)]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["q_row", "query_id", "c_row", "vec_id", "score"]
                )

    met = queries.join(candidates, "part").select("q", "c")
    return met.mapInArrow(
        ranked, "q_row long, query_id long, c_row long, vec_id long, score double"
    )


def search(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    sample: int = SAMPLE,
    partitions: int = PARTITIONS,
    reach: float = REACH,
    seed: int = 20_250,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of ``df`` (vec_id, embedding).

    For each row that ``is_query`` holds for, the ``k`` nearest found of all other
    rows by Euclidean distance, ties to the smaller vec_id; all others, if there are
    fewer. Vectors that are null, empty, zero or hold null or non-finite components
    take no part, nor do those of another length than most. Equal rows are rows of
    their own. A query that meets fewer than ``k`` rows in its partitions is searched
    for in all of them. Partitions are split into blocks, so one that holds a third of
    all rows is no single task's work. The result of an empty table is empty.
    """
    vectors = df.filter(usable("embedding")).select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    lengths = vectors.groupBy(F.size("vector").alias("n")).count()
    most = lengths.orderBy(F.desc("count"), "n").first()
    vectors = vectors.filter(F.size("vector") == (most[0] if most else 0))
    vectors = numbered(vectors, "row", "vectors")
    n = vectors.count()
    share = min(1.0, 1.2 * sample / max(1, n))
    drawn_by = F.xxhash64("row", F.lit(seed))  # the smallest, wherever they lie
    picked = vectors.filter(unit(drawn_by) < share).orderBy(unit(drawn_by), "row").limit(sample)
    drawn = [r[0] for r in picked.select("vector").collect()]
    x = np.array(drawn, np.float64).reshape(len(drawn), most[0] if most else 1)
    router = fit(x, partitions, reach, k, seed)
    parts = len(router.weights[3])

    rows = vectors.select("row", "id", "vector")
    indexed = pinned(route(rows, router, 1), "indexed")
    candidates = pinned(_blocks(indexed, BLOCK, "c"), "candidate-blocks")
    asked = vectors.filter("is_query").select("row", "id", "vector")
    queries = _blocks(route(asked, router, router.probes), QUERIES, "q")
    best = Window.partitionBy("q_row").orderBy("score", "vec_id", "c_row")
    found = _search(queries, candidates, k).withColumn("rank", F.row_number().over(best))
    found = pinned(found.filter(F.col("rank") <= k), "found")
    if router.probes < parts:
        whole = found.groupBy("q_row").count().filter(F.col("count") >= min(k, max(0, n - 1)))
        short = asked.join(whole, asked["row"] == whole["q_row"], "left_anti")
        again = _search(_blocks(route(short, router, parts), QUERIES, "q"), candidates, k)
        again = again.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        found = found.join(whole.select("q_row"), "q_row").select(again.columns).union(again)
    return found.select("query_id", "rank", "vec_id", "score")
