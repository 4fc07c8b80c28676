"""Document fingerprints by a threshold-scaled sketch.

A fingerprint keeps every shingle hash below a fixed fraction of the hash range, so
it grows with its document, fingerprints of parts merge by union, and containment
between very unequal documents can be told from the hashes they share. Only SQL
functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm.common import WORD

SHINGLE_WORDS = 5
FRACTION = 1 / 8
BUCKET_ROWS = 1_000  # rows that one window puts in order
MAX_BUCKETS = 16_384  # bounds in the plan: 128 KB


def shingle_hashes(words: Column, n: int = SHINGLE_WORDS) -> Column:
    """A 64-bit hash for each run of ``n`` words; fewer words are one run."""
    places = F.sequence(F.lit(0), F.size(words) - n)
    runs = F.transform(places, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(n))))
    whole = F.array(F.xxhash64(words))
    none = F.array().cast(T.ArrayType(T.LongType()))
    return F.when(F.size(words) >= n, runs).when(F.size(words) > 0, whole).otherwise(none)


def sketch(hashes: Column, fraction: float = FRACTION) -> Column:
    """The hashes below ``fraction`` of the range, distinct and sorted.

    A document that has shingles but none so low is known by its lowest one, which
    lies above the threshold and so tells that it is one.
    """
    low = int(-(1 << 63) + fraction * (1 << 64))
    kept = F.sort_array(F.array_distinct(F.filter(hashes, lambda h: h < low)))
    lowest = F.array(F.array_min(hashes))
    return F.when((F.size(kept) == 0) & (F.size(hashes) > 0), lowest).otherwise(kept)


def merged(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of both documents' shingles together."""
    return sketch(F.concat(a, b), fraction)


def as_text(kept: Column) -> Column:
    """Sixteen hexadecimal digits for each hash, in order; empty if there is none."""
    return F.array_join(F.transform(kept, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def resemblance(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity, 0 to 1; two documents without shingles are alike."""
    shared = _shared(a, b)
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has; 1 if ``a`` has none."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(_shared(a, b) / F.size(a))


def split_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _buckets(docs: DataFrame) -> tuple[Column, list[int]]:
    """A row's bucket by descending doc_id, and the largest doc_id of each bucket.

    Bounds are looked up in two steps, so a row is compared with some hundred of
    them at most. Rows without a doc_id belong to the last bucket.
    """
    n, top = docs.agg(F.count("*"), F.max("doc_id")).first()
    if top is None:
        return F.lit(0), []
    wanted = min(MAX_BUCKETS, max(1, n // BUCKET_ROWS))
    shares = [(i + 1) / wanted for i in range(wanted)]
    found = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * wanted))).first()[0]
    tops = sorted({*found, top})
    step = math.isqrt(len(tops)) + 1
    runs = [tops[i : i + step] for i in range(0, len(tops), step)]

    def below(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda t: t < F.col("doc_id")))

    run = below(F.array(*(F.lit(r[-1]) for r in runs)))
    within = below(F.get(F.array(*(F.array(*map(F.lit, r)) for r in runs)), run))
    place = F.lit(len(tops) - 1) - (run * step + within)
    return F.coalesce(place, F.lit(len(tops) - 1)).cast("int"), tops[::-1]


def with_next(docs: DataFrame, *columns: str) -> DataFrame:
    """``docs`` with ``next_<column>``: the values of the next row by descending doc_id.

    After the last row comes the first. Rows with one doc_id stand in the order of
    their texts' hashes, rows without one at the end. Buckets of doc_ids are put in
    order one by one; the first row of each also stands at the end of the one before.
    """
    bucket, tops = _buckets(docs)
    at = F.col("__b")
    here = F.struct(at.alias("b"), F.lit(False).alias("guest"))
    before = F.pmod(at - 1, F.lit(max(1, len(tops))))
    there = F.struct(before.alias("b"), F.lit(True).alias("guest"))
    # array_position would look at all bounds: runs of 64, then the place in the run
    runs = F.array(*(F.array(*map(F.lit, tops[i : i + 64])) for i in range(0, len(tops), 64)))
    top = F.get(F.get(runs, F.floor(at / 64).cast("int")), (at % 64).cast("int"))
    first = top == F.col("doc_id") if tops else F.lit(True)
    seats = F.when(first, F.array(here, there)).otherwise(F.array(here))
    seated = docs.withColumn("__b", bucket).withColumn("__seat", F.explode(seats))
    order = Window.partitionBy("__seat.b").orderBy(
        F.col("__seat.guest"), F.col("doc_id").desc_nulls_last(), F.xxhash64("text")
    )
    led = seated.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
    return led.filter(~F.col("__seat.guest")).drop("__b", "__seat")


def fingerprints(
    docs: DataFrame, n: int = SHINGLE_WORDS, fraction: float = FRACTION
) -> DataFrame:
    """Each document (doc_id, text) and an edited one: its last third replaced.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, and the
    likeness of the fingerprint to the edited text's (near_edited, held_edited) and to
    the next document's (near_next, held_next): estimated Jaccard similarity, and the
    share of the document's shingles that the other has.

    The last floor(n / 3) code points give way to the first as many of the next
    document, by descending doc_id. Null texts count as empty. Equal texts have equal
    fingerprints; texts without words have an empty one. An only row is its own next.
    An empty table gives no rows; other columns are not looked at.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kept = sketch(F.col("hashes"), fraction)

    def sketched(df: DataFrame, text: str, name: str) -> DataFrame:
        return (
            df.withColumn("words", split_words(F.col(text)))
            .withColumn("hashes", shingle_hashes(F.col("words"), n))
            .withColumn(name, kept)
            .drop("words", "hashes")
        )

    led = with_next(sketched(rows, "text", "kept"), "text", "kept")
    n_chars = F.length("text")
    tail = F.floor(n_chars / 3).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), n_chars - tail), F.substr("next_text", F.lit(1), tail)
    )
    led = led.select(
        "doc_id",
        n_chars.cast("long").alias("n_chars"),
        edited.alias("edited"),
        "kept",
        "next_kept",
    )
    both = sketched(led, "edited", "edited_kept")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("kept")).alias("fingerprint"),
        as_text(F.col("edited_kept")).alias("edited_fingerprint"),
        resemblance(F.col("kept"), F.col("edited_kept")).alias("near_edited"),
        resemblance(F.col("kept"), F.col("next_kept")).alias("near_next"),
        containment(F.col("kept"), F.col("edited_kept")).alias("held_edited"),
        containment(F.col("kept"), F.col("next_kept")).alias("held_next"),
    )
