"""Toxicity by class-conditional Kneser-Ney models.

Each class, toxic and ordinary, has a model of all its expressions: pairs of following
words, words and stems. A pair counts the texts that have it; the lower orders count, as
Kneser-Ney has it, the different words they follow, so that a text copied many times
tells little of its words. One is taken off each count of a class. What this frees goes
by the next lower order, to which counts that both classes share lend weight: of an
expression seen ``n`` times in all, ``n`` against ``BACKOFF`` counts are its class's own.
So rare expressions have nearly the same probability in both classes, and an expression
that was seen but once in a class has exactly that of its backoff.

A toxic document is ordinary text with toxic expressions in it: each place is taken to
come from the toxic model with probability ``MIXED``, else from the ordinary one. Its
log-likelihood less the ordinary one, over the length, is what the score depends on.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import TEXT_ROWS, arrow_rows, file_rows, let_go, unit
from tallywatch.session import pinned

WORDS = re.compile(r"\w+")
STEM = 4  # letters of the stem that a longer word falls back to
BACKOFF = 10.0  # counts that the shared backoff weighs against an expression's own
MIXED = 0.01  # share of a toxic document's places that come from the toxic model
MODEL_WORDS = 4_000_000  # expressions sent to all workers, 64 MB; rarer ones are joined
FILTER_BITS = 26  # of a filter of 8 MB that says which other expressions to join
SMALL_LABELS = 1_000_000  # labels that may be broadcast: 16 MB
HELD_WORDS = 500_000  # running words that a worker holds before it passes them on
SCORED_WORDS = 100_000  # and before it scores them
PASSED_PAIRS = 50_000  # pairs that a worker passes on at a time: 3 MB
FREQUENT = 0.001  # share of the running words from which a word's pairs are dealt out
FREQUENT_TEXTS = 2_000  # texts, about, that are looked at for such words
DEALT = 64  # parts that the pairs of a frequent word are dealt to
PAIR_ROWS = 40_000  # labelled rows whose pairs are exchanged at a time,
PAIR_ROUNDS = 2  # in so many rounds at most
ROUND_ROWS = 100_000  # rows whose rarer expressions are joined at a time,
ROUNDS = 8  # in so many rounds at most
SAMPLE = 20_000  # labelled rows, about, at most, that the curve is fitted on
CURVE_SHARE = 0.25  # of the labelled rows, as long as that is fewer
CLASSES = ("toxic", "ordinary")
SOFT = 2.0  # differences well above it count by their logarithm in the curve
FOLDS = 5


def tokens(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def word_key(word: str) -> int:
    """A number whose upper half is the same for all words of a stem.

    Negative if the word is long enough for a stem: its first letters.
    """
    low = xxhash.xxh32_intdigest(word)
    if len(word) <= STEM + 1:
        return ((low >> 1) << 32) | xxhash.xxh32_intdigest(word, 1)
    return ((xxhash.xxh32_intdigest(word[:STEM] + "*") >> 1) << 32 | low) - (1 << 63)


def mixed(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """Keys of the model for a word (or stem) and what stands before it."""
    with np.errstate(over="ignore"):
        x = a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= np.asarray(b, np.int64).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))).view(np.int64)


# What stands before: a word's lower half (32 bits), or one of these.
WORD, STEMS, START = 1 << 33, 1 << 34, 1 << 32


def coded(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple]:
    """``batch, first row, last row, starts, keys, places, before`` of about ``most`` words at a time.

    ``keys`` are those of the rows' distinct words, ``places`` which of them each running
    word is, ``before`` what it follows; row i's are ``starts[i]`` to ``starts[i + 1]``.
    """
    for batch in batches:
        texts, low = batch.column("text"), 0
        while low < batch.num_rows:
            index, runs, held, high = {}, [], 0, low
            while high < batch.num_rows and held < most:
                found = tokens(texts[high].as_py())
                places = (index.setdefault(w, len(index)) for w in found)
                runs.append(np.fromiter(places, np.int32, len(found)))
                held += len(found)
                high += 1
            keys = np.fromiter((word_key(w) for w in index), np.int64, len(index))
            starts = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int64)
            places = np.concatenate(runs)
            before = np.empty(held, np.int64)
            before[1:] = keys[places[:-1]] & 0xFFFFFFFF
            before[starts[:-1][starts[:-1] < held]] = START
            yield batch, low, high, starts, keys, places, before
            low = high


def frequent_words(texts: DataFrame) -> np.ndarray:
    """Keys of the words, 1,000 at most, that are ``FREQUENT`` in ``texts`` (text), sorted."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, _, keys, places, _ in coded(batches, HELD_WORDS):
            n = np.bincount(places, minlength=len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["word", "n"])

    counts = texts.select("text").mapInArrow(counted, "word long, n long")
    counts = pinned(counts.groupBy("word").agg(F.sum("n").alias("n")), "sampled-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.filter(F.col("n") > FREQUENT * total).select("word").collect()
    return np.array(sorted(r["word"] for r in found), np.int64)


def sliced(columns: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of ``columns``, ``PASSED_PAIRS`` at a time: the JVM holds a batch beside its heap."""
    batch = pa.RecordBatch.from_arrays(columns, names=names)
    for low in range(0, batch.num_rows, PASSED_PAIRS):
        yield batch.slice(low, PASSED_PAIRS)


def pair_counts(
    labelled: DataFrame, frequent: np.ndarray | None = None, turn: int = 0, rounds: int = 1
) -> DataFrame:
    """``word, before, toxic, ordinary, toxic_held, ordinary_held`` of each pair.

    How many texts have it; ``_held`` are those kept for the curve. ``labelled`` has text,
    toxic and held. Every pair of every text counts. Pairs are exchanged by their word, so
    that rows alike stand together, those of ``frequent`` words in ``DEALT`` parts. Of
    several ``rounds`` each counts the pairs of the words whose key leaves ``turn``.
    """
    frequent = np.zeros(0, np.int64) if frequent is None else frequent
    names = ["ordinary", "toxic", "ordinary_held", "toxic_held"]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, low, high, starts, keys, places, before in coded(batches, HELD_WORDS):
            own = (keys % rounds == turn)[places]
            if not own.any():
                continue
            words, before = keys[places[own]], before[own]
            kinds = batch.column("toxic").to_numpy() + 2 * batch.column("held").to_numpy()
            row = np.repeat(np.arange(high - low), np.diff(starts))[own]
            order = np.lexsort((row, before, words))
            w, b, r = words[order], before[order], row[order]
            same = (w[1:] == w[:-1]) & (b[1:] == b[:-1])
            fresh = np.concatenate([[True], ~(same & (r[1:] == r[:-1]))])
            w, b, kind = w[fresh], b[fresh], kinds[low:high][r[fresh]]
            first = np.concatenate([[True], (w[1:] != w[:-1]) | (b[1:] != b[:-1])])
            group = np.cumsum(first) - 1
            w, b = w[first], b[first]
            part = np.where(np.isin(w, frequent), b % DEALT, 0)
            columns = [pa.array(w), pa.array(part), pa.array(b)]
            for k in range(4):
                n = np.bincount(group[kind == k], minlength=group[-1] + 1)
                columns.append(pa.array(n.astype(np.int64)))
            yield from sliced(columns, ["word", "part", "before", *names])

    kinds = ", ".join(f"{n} long" for n in names)
    counts = labelled.select("text", "toxic", "held").mapInArrow(
        counted, f"word long, part long, before long, {kinds}"
    )
    # a task's rows are sums already; summing them again before the exchange finds little
    counts = counts.repartition("word", "part").groupBy("word", "part", "before")
    return counts.agg(*(F.sum(n).alias(n) for n in names)).drop("part")


def share_of(count: Column, n: Column, share: float, freed: Column, lower: Column) -> Column:
    """An expression's probability in a class over that in both together.

    ``share`` is the class's part of all counts of this order, ``lower`` the same
    quotient one order lower.
    """
    kept = F.greatest(count - 1, F.lit(0))
    return (kept / F.lit(share) + (freed + BACKOFF) * lower) / (n + BACKOFF)


def _order(df: DataFrame, totals: tuple[int, int], lower: tuple[Column, Column]) -> DataFrame:
    """``df`` (toxic, ordinary) with ``n`` and the quotients ``p`` (toxic) and ``q``."""
    both = sum(totals)
    n = F.col("toxic") + F.col("ordinary")
    freed = F.least("toxic", F.lit(1)) + F.least("ordinary", F.lit(1))
    return df.withColumns(
        {
            "n": n,
            "p": share_of(F.col("toxic"), n, totals[0] / both, freed, lower[0]),
            "q": share_of(F.col("ordinary"), n, totals[1] / both, freed, lower[1]),
        }
    )


def gain(p: Column, q: Column) -> Column:
    """What a place adds to the toxic log-likelihood less the ordinary one, in ``MIXED``."""
    return F.log1p(MIXED * (p / q - 1)) / MIXED


def counts_of(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words and pairs, stored once for both models: all texts, and without those held.

    Both have ``toxic, ordinary`` and, without the held texts, ``toxic_less,
    ordinary_less``; for words these are contexts, and ``..._texts`` are the pairs'
    counts. Pairs seen at most once in each class are counted, but not stored.
    """
    less = {f"{c}_less": F.col(c) for c in CLASSES}
    pairs = pairs.withColumns({**less, **{c: F.col(c) + F.col(f"{c}_held") for c in CLASSES}})
    names = [*CLASSES, *less]
    of_words = pairs.groupBy("word").agg(
        *(F.sum((F.col(c) > 0).cast("long")).alias(c) for c in names),
        *(F.sum(c).alias(f"{c}_texts") for c in names),
    )
    often = pairs.select("word", "before", *names).filter("toxic > 1 or ordinary > 1")
    # both halves read one exchange of the pairs
    stored = pinned(often.unionByName(of_words, allowMissingColumns=True), "pairs-and-words")
    return stored.filter("before is null").drop("before"), stored.select("word", "before", *names).filter("before is not null")


def expressions(words: DataFrame, pairs: DataFrame, less: str = "") -> DataFrame | None:
    """``key, n, gain``: what each pair, word and stem adds to that of its backoff.

    From ``counts_of``, its columns that end in ``less``. Expressions that add nothing,
    those seen at most once in each class, are left out; None if a class has no text.
    """
    chosen = [F.col(f"{c}{less}").alias(c) for c in CLASSES]
    whole = [F.sum(c).alias(c) for c in CLASSES]
    words = words.select("word", *chosen, *(F.col(f"{c}{less}_texts").alias(f"{c}_texts") for c in CLASSES))
    summed = words.agg(*(F.sum(f"{c}_texts") for c in CLASSES), *whole).first()
    total = [tuple(summed[:2]), tuple(summed[2:4])]
    if any(not t for totals in total for t in totals):
        return None
    words = words.select("word", *CLASSES).filter("toxic + ordinary > 0")
    often = pairs.select("word", "before", *chosen).filter("toxic > 1 or ordinary > 1")
    stem = F.shiftright("word", 32)
    stems = words.filter("word < 0").groupBy(stem.alias("stem")).agg(*whole)
    one = F.lit(1.0)
    stems = pinned(_order(stems, total[1], (one, one)), "stems")
    lower = stems.select("stem", F.col("p").alias("p0"), F.col("q").alias("q0"))
    words = words.withColumn("stem", stem).join(lower, "stem", "left")
    words = words.fillna({"p0": 1.0, "q0": 1.0})
    words = pinned(_order(words, total[1], (F.col("p0"), F.col("q0"))), "word-models")
    lower = words.select("word", F.col("p").alias("p0"), F.col("q").alias("q0"))
    often = often.join(lower, "word")
    often = _order(often, total[0], (F.col("p0"), F.col("q0")))
    own, below = gain(F.col("p"), F.col("q")), gain(F.col("p0"), F.col("q0"))
    parts = [
        stems.select(F.col("stem").alias("a"), F.lit(STEMS).cast("long").alias("b"), "n", own.alias("gain")),
        words.select(F.col("word").alias("a"), F.lit(WORD).cast("long").alias("b"), "n", (own - below).alias("gain")),
        often.select(F.col("word").alias("a"), F.col("before").alias("b"), "n", (own - below).alias("gain")),
    ]
    found = parts[0].unionByName(parts[1]).unionByName(parts[2])
    found = found.filter((F.abs("gain") > 1e-12))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in ("a", "b"))
            columns = [pa.array(mixed(a, b)), batch.column("n"), batch.column("gain")]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "gain"])

    return pinned(found.mapInArrow(keyed, "key long, n long, gain double"), "expressions")


@dataclass
class Model:
    """Gains by key: ``keys`` (sorted) and ``gains`` go to all workers, ``rest`` is joined."""

    keys: np.ndarray
    gains: np.ndarray
    rest: DataFrame | None = None
    filter: np.ndarray | None = None
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)


def filter_bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the filter that a key has."""
    k, last = keys.view(np.uint64), np.uint64((1 << FILTER_BITS) - 1)
    return (k & last).astype(np.int64), ((k >> np.uint64(FILTER_BITS)) & last).astype(np.int64)


def loaded(found: DataFrame | None) -> Model:
    """The most frequent expressions for the workers; if there are more, a filter for the rest.

    The filter has a fixed size and is made in tasks from the table's keys; one that is
    too full lets more keys pass to the join, which is exact.
    """
    if found is None:
        return Model(np.zeros(0, np.int64), np.zeros(0))
    size = F.floor(F.log2("n") * 16).cast("int")
    sizes = found.groupBy(size.alias("size")).count().orderBy(F.desc("size")).collect()  # some 1,000 at most
    cut, total = None, 0
    for r in sizes:
        if total + r["count"] > MODEL_WORDS:
            cut = r["size"]
            break
        total += r["count"]
    head = (found if cut is None else found.filter(size > cut)).select("key", "gain")
    keys, gains = [], []
    for top in range(-4, 4):  # by the key's first bits, so that little is held twice
        some = head.filter(F.shiftright("key", 61) == top).toArrow()
        key, gain_ = (some.column(c).to_numpy() for c in ("key", "gain"))
        order = np.argsort(key, kind="stable")
        keys.append(key[order])
        gains.append(gain_[order])
    model = Model(np.concatenate(keys), np.concatenate(gains))
    del keys, gains
    if cut is None:
        return model
    model.rest = found.filter(size <= cut).select("key", "gain")

    def set_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = filter_bits(batch.column("key").to_numpy())
            bits = np.concatenate([low, high])
            part = pa.array((bits >> 16).astype(np.int32)), pa.array((bits & 0xFFFF).astype(np.int32))
            yield pa.RecordBatch.from_arrays(list(part), names=["part", "bit"])

    bits = model.rest.select("key").mapInArrow(set_bytes, "part int, bit int")
    # at most 2^20 numbers of 64 bits, whatever the number of keys
    maps = bits.groupBy("part", F.floor(F.col("bit") / 64).alias("place")).agg(
        F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("mask")
    )
    table = maps.toArrow()
    words = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    part, place, mask = (table.column(c).combine_chunks().to_numpy() for c in ("part", "place", "mask"))
    words[part.astype(np.int64) * 1024 + place] = mask
    model.filter = words
    return model


def looked_up(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``asked`` are in ``keys`` (sorted), and where they would be."""
    if not len(keys):
        return np.zeros(len(asked), bool), np.zeros(len(asked), np.int64)
    at, order = np.empty(len(asked), np.int64), np.argsort(asked)
    at[order] = np.searchsorted(keys, asked[order])  # in order, memory is read in order
    at = np.minimum(at, len(keys) - 1)
    return keys[at] == asked, at


def sums(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` with ``__mean`` and ``__root``: the gains' sum over the words, and over their root.

    Written to the shared folder. A long ``__row`` in ``keep`` must be a row's own, as
    ``file_rows`` gives it.
    """
    spark, joined = docs.sparkSession, model.rest is not None
    columns = list(dict.fromkeys([*keep, "text"]))
    docs = docs.select(*columns)
    if joined and "__row" not in keep:
        docs = file_rows(docs, "__row", "scored-input")
    sent = spark.sparkContext.broadcast((model.keys, model.gains, model.filter))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        keys, gains, bits = sent.value
        for batch, low, high, starts, words, places, before in coded(batches, SCORED_WORDS):
            size = np.diff(starts)
            row = np.repeat(np.arange(high - low), size)
            told = np.zeros(len(places))
            asked = ([], [])
            # words and stems are looked up once for all places that have them
            for own, where in (
                (mixed(words[places], before), None),
                (mixed(words, WORD), places),
                (mixed(words >> 32, STEMS), places),
            ):
                known, at = looked_up(keys, own)
                gain_ = np.zeros(len(own))
                gain_[known] = gains[at[known]]
                told += gain_ if where is None else gain_[where]
                if bits is None:
                    continue
                maybe = ~known
                for x in filter_bits(own):
                    maybe &= (bits[x >> 6] >> (x & 63)) & 1 == 1
                if where is not None:
                    own, maybe = own[where], maybe[where]
                asked[0].append(row[maybe])
                asked[1].append(own[maybe])
            told = np.bincount(row, weights=told, minlength=high - low)
            asked = tuple(map(np.concatenate, asked)) if bits is not None else None
            yield batch.slice(low, high - low), told, size, asked

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, told, size, _ in added(batches):
            n = np.maximum(size, 1)
            out = [batch.column(c) for c in keep]
            out += [pa.array(told / n), pa.array(told / np.sqrt(n))]
            yield pa.RecordBatch.from_arrays(out, names=[*keep, "__mean", "__root"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, told, size, (row, key) in added(batches):
            rows = batch.column("__row").to_numpy()
            order = np.lexsort((key, row))
            row, key = row[order], key[order]
            first = np.ones(len(row), bool)
            first[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
            n = np.diff(np.append(np.flatnonzero(first), len(row)))
            row, key, none = row[first], key[first], np.zeros(len(rows), np.int64)
            # a row of its own for each document, under a key of its own that counts no times
            columns = [
                pa.array(np.concatenate([rows, rows[row]])),
                pa.array(np.concatenate([mixed(rows, WORD), key])),
                pa.array(np.concatenate([none, n])),
                pa.array(np.concatenate([told, np.zeros(len(row))])),
                pa.array(np.concatenate([size, np.zeros(len(row), np.int64)])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["__row", "key", "n", "told", "size"])

    if not joined:
        kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
        with arrow_rows(spark, TEXT_ROWS):
            out = pinned(docs.mapInArrow(scored, f"{kinds}, __mean double, __root double"), "scored")
        sent.destroy()
        return out
    rounds = max(1, min(ROUNDS, -(-docs.count() // ROUND_ROWS)))
    found = []
    for turn in range(rounds):  # the exchange of what a round's rows ask for goes with it
        some = docs.filter(F.pmod(F.xxhash64("__row"), F.lit(rounds)) == turn)
        asked = some.select("__row", "text").mapInArrow(
            spread, "__row long, key long, n long, told double, size long"
        )
        told = asked.join(model.rest, "key", "left").groupBy("__row").agg(
            (F.sum("told") + F.sum(F.col("n") * F.coalesce("gain", F.lit(0.0)))).alias("__told"),
            F.greatest(F.sum("size"), F.lit(1)).alias("__size"),
        )
        with arrow_rows(spark, TEXT_ROWS):
            found.append(pinned(told, "told"))
        let_go(spark)
    sent.destroy()
    found, total = reduce(DataFrame.union, found), F.col("__told")
    return docs.select(*dict.fromkeys(["__row", *keep])).join(found, "__row").select(
        *keep, (total / F.col("__size")).alias("__mean"), (total / F.sqrt("__size")).alias("__root")
    )


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of the label on the two differences' arsinh, slightly shrunk."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.01
        return (math.log(share / (1 - share)), 0.0, 0.0)
    centre, scale = x.mean(0), x.std(0) + 1e-9
    design, w = np.column_stack([np.ones(len(y)), (x - centre) / scale]), np.zeros(3)
    shrink = np.diag([1e-6, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -35, 35)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + shrink
        step = np.linalg.solve(hessian, design.T @ (y - p) - shrink @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    slopes = w[1:] / scale
    return (float(w[0] - slopes @ centre), float(slopes[0]), float(slopes[1]))


def fold(doc_id: str | Column) -> Column:
    """The document's fold, 0 to 4; null for a null doc_id."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labelled documents outside fold 0.

    Counts cover all of them. The curve's three numbers are fitted on about ``sample``
    of them, or ``CURVE_SHARE`` if that is fewer, drawn by a hash of doc_id, as a model
    of the others sees them.
    """
    known = (
        labels.filter(F.col("toxic").isin(0, 1) & (fold("doc_id") != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    known = pinned(known, "known")
    n = known.count()
    share = min(CURVE_SHARE, sample / max(1, n))
    known = known.withColumn(
        "held", (unit(F.xxhash64("doc_id", F.lit("curve"))) < share).cast("int")
    )
    side = F.broadcast(known) if n <= SMALL_LABELS else known
    labelled = docs.select("doc_id", "text").join(side, "doc_id")
    some = unit(F.xxhash64("doc_id", F.lit("words"))) < FREQUENT_TEXTS / max(1, n)
    frequent = frequent_words(labelled.filter(some))
    rounds = max(1, min(PAIR_ROUNDS, -(-n // PAIR_ROWS)))
    counts = []
    for turn in range(rounds):  # a word's pairs are in one of them, and their exchange goes with it
        with arrow_rows(docs.sparkSession, TEXT_ROWS):
            counts.append(counts_of(pair_counts(labelled, frequent, turn, rounds)))
        let_go(docs.sparkSession)
    counts = [reduce(DataFrame.union, x) for x in zip(*counts)]
    others = expressions(*counts, "_less")
    every = expressions(*counts) if others is not None else None
    let_go(docs.sparkSession)
    if every is None:
        model = loaded(None)
        some = [r[0] for r in known.select("toxic").limit(sample).collect()]
        model.curve = fit_curve(np.zeros((len(some), 2)), np.zeros(len(some)) + max(some or [0]))
        return model
    rows = sums(labelled.filter("held = 1"), loaded(others), ["toxic"]).collect()
    x = np.arcsinh(np.array([(r["__mean"], r["__root"]) for r in rows], float).reshape(-1, 2) / SOFT)
    let_go(docs.sparkSession)
    model = loaded(every)
    model.curve = fit_curve(x, np.array([r["toxic"] for r in rows], float))
    return model


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` with ``score``, 0 to 1, for each row of ``docs``."""
    base, mean, root = model.curve
    soft = [F.asinh(F.col(c) / SOFT) for c in ("__mean", "__root")]
    z = F.lit(base) + mean * soft[0] + root * soft[1]
    return sums(docs, model, keep).withColumn("score", 1 / (1 + F.exp(-z))).drop("__mean", "__root")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs`` (doc_id, text).

    Learns from the rows of ``labels`` (doc_id, toxic) whose fold is not 0; fold 0 is
    held out. Labels other than 0 and 1 are not used; a document labelled twice is
    toxic if one label says so. Null and empty texts get the score of a text without
    evidence, as does every text when a class has no text to count. Very
    long texts are read whole; the score goes by their length. A null doc_id is held
    out. Repeated rows are scored each; an empty table gives no rows. Other columns,
    whatever their names, are not read.
    """
    out = score(docs, train(docs, labels), ["doc_id"])
    return out.select(
        "doc_id",
        F.coalesce(fold("doc_id") == 0, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
