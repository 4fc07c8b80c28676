"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots, each a block of the same number of words. The slots'
places on the circle, steps of the golden ratio, are looked up in the sources'
cumulative shares, so any stretch of the mix holds each source in its share. A
source's slots are ranked, and slot number k takes block number k of the source:
its documents in a random order, one after the other, cut into equal blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.llm.common import WORD, by_ids, content, file_rows, ranked, unit
from tallywatch.operators.spread import position
from tallywatch.session import pinned

GOLDEN = 0x9E3779B97F4A7C15  # 2^64 divided by the golden ratio
BLOCK_WORDS = 64
CHUNK = 65_536  # slots whose order one task works out
CELL_ROWS = 2_000  # documents of a source whose order one task works out
BUCKETS_A_SOURCE = 64
STRETCH = 10_000  # documents of the mix that are put in order together


def source_targets(
    sized: DataFrame, weights: Sequence[int], share: float, most: float
) -> DataFrame:
    """``source, rank, source_size, rows, target`` of ``sized`` (source, size).

    Sources by code point, null last, have ``weights``, repeating, and share
    ``share`` of all sizes; a target stops at ``most`` times its source's size, the
    excess is shared by weight again until none is above.
    """
    sums = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("rows")
    )
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int")
    )
    sources = pinned(
        ranked(sums, "rank", F.col("source").asc_nulls_last(), label="sources")
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * float(most)),
        "source-weights",
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    # level: words a weight of 1 gets; sources whose cap lies below it get their cap
    level, before = 0.0, -1.0
    while level > before:
        before = level
        capped = F.col("cap") < level * F.col("weight")
        held, open_weight = sources.agg(
            F.sum(F.when(capped, F.col("cap")).otherwise(0.0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))),
        ).first()
        if not open_weight:
            break
        level = max(level, (share * total - held) / open_weight)
    return sources.withColumn("target", F.least("cap", level * F.col("weight"))).drop(
        "weight", "cap"
    )


def _slots(targets: DataFrame, block_words: int) -> DataFrame:
    """``slot, rank, k``: the source of each slot and the slot's number in it."""
    spark = targets.sparkSession
    total, n_sources = targets.agg(F.sum("target"), F.count("*")).first()
    n = round((total or 0.0) / block_words) + n_sources
    buckets = BUCKETS_A_SOURCE * max(1, n_sources)

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column(0).to_numpy(zero_copy_only=False)
            place = (slot.astype(np.uint64) * np.uint64(GOLDEN)) >> np.uint64(11)
            x = place.astype(np.float64) / float(1 << 53)
            columns = [pa.array(slot), pa.array(x), pa.array((x * buckets).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["slot", "x", "bucket"])

    # each source's stretch of [0, 1), by the buckets it touches
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = targets.withColumn("part", F.floor(F.col("rank") / CHUNK))
    starts = by_part.groupBy("part").agg(F.sum("target").alias("t"))
    starts = starts.select("part", F.coalesce(F.sum("t").over(before), F.lit(0.0)).alias("base"))
    high = F.sum("target").over(Window.partitionBy("part").orderBy("rank")) + F.col("base")
    whole = float(total or 1.0)
    stretch = (
        by_part.filter("target > 0")
        .join(starts, "part")
        .withColumn("high", high)
        .select(
            "rank",
            ((F.col("high") - F.col("target")) / whole).alias("low"),
            (F.col("high") / whole).alias("high"),
        )
    )
    # stretches meet: a low end is the high end of the one before
    stretch = stretch.withColumn(
        "bucket",
        F.explode(
            F.sequence(
                F.floor(F.col("low") * buckets) - 1, F.floor(F.col("high") * buckets) + 1
            )
        ),
    )
    slots = spark.range(n).mapInArrow(points, "slot long, x double, bucket long")
    found = (
        slots.join(stretch, "bucket")
        .filter("x >= low and x < high")
        .groupBy("slot")
        .agg(F.min("rank").alias("rank"))
        .withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    )
    found = pinned(found, "slots")
    counts = found.groupBy("rank", "chunk").agg(F.count("*").alias("n"))
    until = F.sum("n").over(Window.partitionBy("rank").orderBy("chunk")) - F.col("n")
    place = F.row_number().over(Window.partitionBy("rank", "chunk").orderBy("slot")) - 1
    hit = (
        found.withColumn("place", place)
        .join(counts.select("rank", "chunk", until.alias("until")), ["rank", "chunk"])
        .select("slot", "rank", (F.col("until") + F.col("place")).alias("k"))
    )
    # what the points have missed comes after them, in random order
    have = counts.groupBy("rank").agg(F.sum("n").alias("have"))
    missing = (
        targets.join(have, "rank", "left")
        .select(
            "rank",
            F.coalesce("have", F.lit(0)).alias("have"),
            F.ceil(F.round("target") / block_words).alias("need"),
        )
        .filter("have < need")
        .select("rank", F.explode(F.sequence(F.col("have"), F.col("need") - 1)).alias("k"))
    )
    order = (F.xxhash64("rank", "k"), F.col("rank"), F.col("k"))
    missing = ranked(missing, "at", *order, label="missing-slots")
    return hit.unionByName(missing.select((F.col("at") + n).alias("slot"), "rank", "k"))


def _blocks(rows: DataFrame, targets: DataFrame, block_words: int, seed: int) -> DataFrame:
    """``rank, k, row, epoch, start, length``: what lies in block k of each source.

    A source whose target is above its size starts again in another order; its last
    block ends where the target is reached.
    """
    share = F.col("target") / F.col("source_size")
    dealt = (
        rows.filter("size > 0")
        .join(targets.filter("target > 0"), F.col("src") == F.col("rank"))
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.ceil(share).cast("int") - 1)))
        .withColumn("key", F.xxhash64(F.lit(seed), "epoch", "content", "copy"))
        .withColumn("cells", F.ceil(F.col("rows") / CELL_ROWS))
        .withColumn("cell", F.floor(unit(F.col("key")) * F.col("cells")))
    )
    sums = dealt.groupBy("rank", "epoch", "cell").agg(F.sum("size").alias("s"))
    before = Window.partitionBy("rank", "epoch").orderBy("cell")
    base = sums.select(
        "rank", "epoch", "cell", (F.sum("s").over(before) - F.col("s")).alias("base")
    )
    within = Window.partitionBy("rank", "epoch", "cell").orderBy("key", "content", "copy")
    placed = (
        dealt.withColumn("upto", F.sum("size").over(within))
        .join(base, ["rank", "epoch", "cell"])
        .withColumn(
            "low",
            F.col("epoch") * F.col("source_size") + F.col("base") + F.col("upto") - F.col("size"),
        )
        .withColumn("end", F.least(F.col("low") + F.col("size"), F.round("target").cast("long")))
        .filter("end > low")
    )
    b = F.lit(block_words)
    k = F.explode(F.sequence(F.floor(F.col("low") / b), F.floor((F.col("end") - 1) / b)))
    cut = placed.select("rank", "row", "epoch", "low", "end", k.alias("k"))
    start = F.greatest(F.col("k") * b, "low")
    return cut.select(
        "rank",
        "k",
        "row",
        "epoch",
        (start - F.col("low")).alias("start"),
        (F.least((F.col("k") + 1) * b, "end") - start).alias("length"),
    )


def mix(
    rows: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = BLOCK_WORDS,
    seed: int = 20_242,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix of ``rows`` (row, a unique number; source; size in words; content).

    ``content`` is a number made from what the row holds (equal rows share it); the order
    of the documents comes from it and from a count among equal rows, so the mix does not
    depend on files, splits or cores.

    Returns the rows with their source's ``source_size`` and ``target``; the
    sources; and the mix itself, ``slot, row, epoch, start, length``: the words of
    each slot. A slot whose source has run out of words (targets are whole words,
    slots are blocks) has none; blocks that no point has hit get slots at the end, so
    each source has its target to the word. Rows without words are never taken.
    """
    targets = pinned(source_targets(rows, weights, share, most), "targets")
    named = targets.select(F.col("source").alias("s"), "rank", "source_size", "target")
    with_source = rows.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    keyed = with_source.select("row", "size", F.col("rank").alias("src"), "content")
    keyed = position(keyed, ["content"], "content", "row", "copy")
    blocks = _blocks(keyed, targets.drop("source"), block_words, seed)
    slots = _slots(targets.select("rank", "target"), block_words)
    mixed = slots.join(blocks, ["rank", "k"]).select("slot", "row", "epoch", "start", "length")
    return with_source.drop("rank"), targets, mixed


def taken(rows: DataFrame, **how) -> DataFrame:
    """``rows`` with ``source_size``, ``target`` and ``taken``: the words the mix has of each.

    Repeats counted. A null source is one source, the last. With no words at all
    every target is 0. Repeated rows are documents of their own; an empty table gives no
    rows.
    """
    sized, _, mixed = mix(rows, **how)
    sums = mixed.groupBy("row").agg(F.sum("length").alias("taken"))
    return sized.join(sums, "row", "left").withColumn(
        "taken", F.coalesce("taken", F.lit(0)).cast("long")
    )


def mixed_documents(docs: DataFrame, size: Column, **how) -> DataFrame:
    """The documents of the mix, in the columns of ``docs``.

    A document comes once for each time the mix takes it. One that it takes in part
    (at most one for each source) comes up to the last word taken, its white space as
    it was, and with its number of characters. Rows come in the order of the mix, by the
    first slot that has a word of them: files written from the result are in that order,
    one after the other, so any stretch holds each source in its share.

    Null texts and texts without words are never taken; repeated rows are documents of
    their own; an empty table gives no rows.
    """
    known = file_rows(docs, "__row", "mix-input")
    rows = known.select(
        F.col("__row").alias("row"), "source", size.alias("size"), content(docs).alias("content")
    )
    _, _, mixed = mix(pinned(rows, "mix-sizes"), **how)
    copies = mixed.groupBy(F.col("row").alias("__row"), "epoch").agg(
        F.sum("length").alias("__words"), F.min("slot").alias("__slot")
    )
    copies = pinned(copies.select("__row", "__words", "__slot"), "copies")
    out = by_ids(known.withColumn("__size", size), copies, "__row", "inner")
    words = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    words = F.slice(words, F.lit(1), F.col("__words").cast("int"))
    part = F.col("__words") < F.col("__size")
    out = out.withColumn(
        "text", F.when(part, F.array_join(words, "")).otherwise(F.col("text"))
    )
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(part, n_chars).otherwise(F.col("n_chars")))
    # stretches of about as many copies each; bounds from the copies, not from the texts
    n, top = copies.agg(F.count("*"), F.max("__slot")).first()
    parts = max(1, min(-(-n // STRETCH), (top or 0) + 1))
    stretch = F.floor(F.col("__slot") * parts / ((top or 0) + 1)).cast("int")
    placed = out.withColumn("__stretch", stretch)
    ordered = placed.repartitionById(parts, "__stretch").sortWithinPartitions("__slot", content(docs))
    return ordered.select(*docs.columns)
