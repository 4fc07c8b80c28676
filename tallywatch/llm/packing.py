"""Best-fit packing of tokenised documents into sequences of bounded length.

Hierarchical residual packing. Items are dealt to groups by their number; each
group packs best-fit decreasing on its own and emits its nearly full bins. The
underfull bins of all groups are items of the next round, in fewer groups, until
one group is left or a round closes hardly any bin.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm.common import numbered
from tallywatch.session import pinned

GROUP_ITEMS = 25_000  # items that one task packs
FULL_AT = 1.0 - 1 / 128  # a bin filled so far is closed
SHRINK = 0.95  # another round follows only if underfull bins are fewer than this of the items


@cache
def encoder(ranks_path: str):
    """A tokenizer's encoder, once for each worker; special strings are plain text.

    ``ranks_path`` holds the vocabulary as ranks: ids equal those of the JSON file
    of the same vocabulary, five times as fast.
    """
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def ranks_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pieces(
    docs: DataFrame,
    max_tokens: int = 1024,
    end_id: int = 2,
    ranks_path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """The token pieces of each document: ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document is the ids of its text (null: empty) and ``end_id``. Longer ones are
    cut into pieces of ``max_tokens``; the first piece has what is left over.
    ``with_ids`` adds the ids themselves.
    """
    path = ranks_path or ranks_file()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for batch in batches:
            texts = batch.column("text")
            at, piece, start, length, crc, tokens = [], [], [], [], [], []
            for i in range(batch.num_rows):
                ids = encode(texts[i].as_py() or "")
                ids.append(end_id)
                n, raw = len(ids), memoryview(np.array(ids, dtype="<u4").tobytes())
                first = n % max_tokens or max_tokens
                for k, low in enumerate([0, *range(first, n, max_tokens)]):
                    high = first + k * max_tokens
                    at.append(i)
                    piece.append(k)
                    start.append(low)
                    length.append(high - low)
                    crc.append(zlib.crc32(raw[4 * low : 4 * high]))
                    if with_ids:
                        tokens.append(ids[low:high])
            columns = [
                batch.column("doc_id").take(pa.array(at, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(tokens, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
        ]
    )
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, longest first, each in the fullest bin it fits.

    Bins wait by the room they have left; one bit for each room that any bin has.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, made = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            at = waiting[room].pop()
            if not waiting[room]:
                rooms &= ~(1 << room)
        else:
            room, at, made = capacity, made, made + 1
        bins[i], offsets[i] = at, capacity - room
        if left := room - n:
            waiting[left].append(at)
            rooms |= 1 << left
    return bins, offsets


def _round(items: DataFrame, groups: int, capacity: int) -> DataFrame:
    """Each item's bin (the number of its first item), offset there and the bin's fill."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("item", ignore_index=True)
        bins, offsets = best_fit(group["length"].to_numpy(), capacity)
        fill = np.bincount(bins, weights=group["length"]).astype(np.int64)
        head = np.full(len(fill), -1, np.int64)
        first = offsets == 0
        head[bins[first]] = group["item"].to_numpy()[first]
        return pd.DataFrame(
            {"item": group["item"], "bin": head[bins], "offset": offsets, "fill": fill[bins]}
        )

    dealt = items.withColumn("group", F.pmod(F.xxhash64("item", F.lit(groups)), F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(pack, "item long, bin long, offset long, fill long")


def pack_items(
    items: DataFrame,
    capacity: int = 1024,
    group_items: int = GROUP_ITEMS,
    full_at: float = FULL_AT,
) -> DataFrame:
    """``item, length`` (1 to ``capacity``) to ``item, sequence_id, offset``."""
    spark = items.sparkSession
    rounds, n = [], items.count()
    while n:
        groups = -(-n // group_items)
        packed = pinned(_round(items, groups, capacity), "packed")
        rounds.append(packed)
        items = packed.filter((F.col("offset") == 0) & (F.col("fill") < int(full_at * capacity)))
        items = items.select(F.col("bin").alias("item"), F.col("fill").alias("length"))
        before, n = n, items.count()
        if groups == 1 or n > SHRINK * before:
            break
    if not rounds:
        return spark.createDataFrame([], "item long, sequence_id long, offset long")
    out = rounds[0].select("item", F.col("bin").alias("sequence_id"), "offset")
    for later in rounds[1:]:
        moved = later.select(
            F.col("item").alias("sequence_id"),
            F.col("bin").alias("__bin"),
            F.col("offset").alias("__by"),
        )
        out = out.join(moved, "sequence_id", "left").select(
            "item",
            F.coalesce("__bin", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("__by", F.lit(0))).alias("offset"),
        )
    return out


def pack(
    docs: DataFrame,
    max_tokens: int = 1024,
    end_id: int = 2,
    ranks_path: str | None = None,
    group_items: int = GROUP_ITEMS,
) -> DataFrame:
    """A row for each piece of each document, with its sequence and place there.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null and
    empty texts are a piece of one token. Repeated rows are packed each for itself;
    a null doc_id is kept. Pieces of full length have a sequence of their own. An
    empty table gives no rows; other columns of ``docs`` are not looked at.
    """
    cut = numbered(pieces(docs, max_tokens, end_id, ranks_path), "item", "pieces")
    partial = cut.filter(F.col("length") < max_tokens).select("item", "length")
    placed = pack_items(partial, max_tokens, group_items)
    return cut.join(placed, "item", "left").select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce("sequence_id", "item").alias("sequence_id"),
        F.coalesce("offset", F.lit(0).cast("long")).alias("offset"),
    )
