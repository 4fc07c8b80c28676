"""Sharding: a uniform shuffle into shards of exactly known sizes.

Hypergeometric communication matrix. How many rows go from each input partition
to each shard is drawn first, as a random permutation would have it: a
multivariate hypergeometric draw for each partition from what the shards still
hold. Each partition deals its rows by its row of the matrix in random order,
rows are exchanged by shard, and each shard is put in random order again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm.common import with_fields
from tallywatch.session import pinned

GROUPS = 1024  # partitions are drawn for in so many groups at most
CHUNK = 8192  # rows dealt by one draw
CELL_ROWS = 50_000  # rows of a shard that one task puts in order
KEY, CELL = "__shuffle_key", "__shuffle_cell"


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Of ``n`` drawn from ``good + bad``, how many are good; any population size.

    Beyond the range of numpy's sampler the probabilities around the mode are
    summed up directly; what lies 12 standard deviations away is left out.
    """
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    low, high = max(0, n - bad), min(good, n)
    share = good / (good + bad)
    sd = np.sqrt(n * share * (1 - share) * (good + bad - n) / (good + bad - 1)) + 1
    mode = min(high, max(low, int((n + 1) * (good + 1) / (good + bad + 2))))
    low, high = max(low, int(mode - 12 * sd)), min(high, int(mode + 12 * sd))
    k = np.arange(low, high, dtype=np.float64)
    step = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    log_p = np.concatenate([[0.0], np.cumsum(step)])
    p = np.cumsum(np.exp(log_p - log_p.max()))
    return low + int(np.searchsorted(p, rng.random() * p[-1], side="right"))


def draw_row(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """How many of ``n`` rows go to each shard that has ``left`` places left."""
    out, rest = np.zeros(len(left), dtype=np.int64), int(left.sum())
    for i, places in enumerate(left.tolist()):
        if n == 0:
            break
        rest -= places
        out[i] = hypergeometric(rng, places, rest, n) if rest else n
        n -= int(out[i])
    return out


def _group_of(part: int, parts: int) -> int:
    return part * min(parts, GROUPS) // parts


def _matrix(seed: int, sizes: list[int], shards: int) -> np.ndarray:
    """A row of the communication matrix for each group of partitions."""
    rng = np.random.default_rng([seed, 1])
    rows, parts = sum(sizes), len(sizes)
    left = np.full(shards, rows // shards, dtype=np.int64)
    left[rng.permutation(shards)[: rows % shards]] += 1
    held = np.zeros(min(parts, GROUPS), dtype=np.int64)
    for part, n in enumerate(sizes):
        held[_group_of(part, parts)] += n
    out = np.zeros((len(held), shards), dtype=np.int64)
    for g, n in enumerate(held.tolist()):
        out[g] = draw_row(rng, left, n)
        left -= out[g]
    return out


def _row_of(seed: int, sizes: list[int], matrix: np.ndarray, part: int) -> np.ndarray:
    """The partition's own row: its group's row dealt on, partition by partition."""
    group = _group_of(part, len(sizes))
    rng, left = np.random.default_rng([seed, 2, group]), matrix[group].copy()
    own = left
    first = -(-group * len(sizes) // len(matrix))
    for at in range(first, part + 1):
        own = draw_row(rng, left, sizes[at])
        left -= own
    return own


def deal(df: DataFrame, sizes: list[int], shards: int, seed: int) -> DataFrame:
    """Each row's shard and a random key; the same for any columns of the stored rows."""
    matrix = _matrix(seed, sizes, shards)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        left = None
        shard, key = np.zeros(0, np.int32), np.zeros(0, np.int64)
        chunk = 0
        for batch in batches:
            if left is None:
                left = _row_of(seed, sizes, matrix, part)
            while len(shard) < batch.num_rows:
                # chunks of one length, so that batch sizes don't matter
                rng = np.random.default_rng([seed, 3, part, chunk])
                take = min(CHUNK, int(left.sum()))
                counts = draw_row(rng, left, take)
                left -= counts
                more = np.repeat(np.arange(shards, dtype=np.int32), counts)
                rng.shuffle(more)
                shard = np.concatenate([shard, more])
                key = np.concatenate([key, rng.integers(0, 1 << 62, take, dtype=np.int64)])
                chunk += 1
            n = batch.num_rows
            columns = [*batch.columns, pa.array(shard[:n]), pa.array(key[:n])]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "shard", KEY])
            shard, key = shard[n:], key[n:]

    schema = with_fields(df.schema, ("shard", T.IntegerType()), (KEY, T.LongType()))
    return df.mapInArrow(dealt, schema)


def shuffle_into_shards(
    df: DataFrame, shards: int = 40, seed: int = 20_241, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``df`` with ``shard`` (0 up to ``shards``) and ``slot`` (its place there, from 0).

    Every order of the rows is equally likely; shard sizes differ by one at most
    (law ``rows``). Values are not looked at, so hot keys, equal rows, nulls and
    empty texts make no difference. An empty table gives no rows. Columns named
    ``shard`` or ``slot`` are replaced. The rows are written to the shared folder
    first: what a partition holds must not change between counting and dealing.
    """
    stored = pinned(df.drop("shard", "slot"), "shard-input")
    counts = dict(stored.groupBy(F.spark_partition_id().alias("p")).count().collect())
    sizes = [counts.get(p, 0) for p in range(max(counts, default=0) + 1)]
    cells = max(1, -(-sum(sizes) // (shards * cell_rows)))
    cell = (F.col(KEY) % cells).cast("int") if cells > 1 else F.lit(0)

    narrow = stored.select(stored.columns[0])
    starts = (
        deal(narrow, sizes, shards, seed)
        .groupBy("shard", cell.alias(CELL))
        .agg(F.count("*").alias("__n"))
        .withColumn(
            "__start",
            F.sum("__n").over(Window.partitionBy("shard").orderBy(CELL)) - F.col("__n"),
        )
        .drop("__n")
    )
    order = Window.partitionBy("shard", CELL).orderBy(KEY, stored.columns[0])
    placed = deal(stored, sizes, shards, seed).withColumn(CELL, cell)
    placed = placed.withColumn("slot", F.row_number().over(order).cast("long") - 1)
    if cells > 1:
        placed = placed.join(starts, ["shard", CELL]).withColumn(
            "slot", F.col("slot") + F.col("__start")
        )
    return placed.select(*stored.columns, "shard", "slot")
