"""N-gram Jaccard join by parity sketches.

Every shingle flips one bit of its document's sketch, so the Hamming distance of
two sketches is at most the symmetric difference of the sets. Two sets that link
differ in at most ``d`` shingles, which their sizes bound. In each band of sizes
the sketch is cut into ``d + 1`` segments: two that link have an equal segment
(pigeonhole). Further, some equal segment is followed by one that differs in one bit at
most, the next two together in two, and so on: if each run of segments came to its
length somewhere, going round from run to run would bring the sum above ``d``. Documents
meet in the buckets of their segments, with the two segments that follow; pairs that
pass are tried by a sketch of all their bits, and then checked on the shingles
themselves.

No bucket is expanded into all its pairs. First its members are checked against
one of them; what is connected then needs no further check, and only pairs between
different components of a bucket are tried after that.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm.common import TEXT_ROWS, arrow_rows, by_ids, content, file_rows, let_go
from tallywatch.llm.components import components
from tallywatch.session import pinned

NGRAM = 4
SIMILAR = Fraction(85, 100)
WORD_CACHE = 100_000  # hashes of words a worker remembers
BUCKET_ROWS = 1_500_000  # rows of a partition of the bucket exchange
ROUNDS = 4  # exchanges that large tables' buckets are dealt in, one after the other
ROUND_ROWS = 12_000_000  # rows up to which one exchange will do
LEVELS = 4  # how often large buckets are met: as they are, and split up to three times
FEW = 16  # members of a bucket up to which its pairs are compared as it passes
BAND_AT = 55  # bits of a bucket's key below its band; the segment's number takes 23
BLOCK = 4096  # members of a larger bucket that are compared in one go
MASKS = np.array([0, 0x5DEECE66D1234567, 0x2545F4914F6CDD1D, 0x1F83D9ABFB41BD6B], np.int64)
ODD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all bits (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


_word_hashes = _WordHashes()


def shingle_set(text: bytes | None, n: int = NGRAM) -> np.ndarray:
    """Hashes of the distinct n-word shingles, sorted; A-Z count as a-z."""
    words = (text or b"").lower().split()  # bytes: ASCII letters, ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(_word_hashes.__getitem__, words), np.uint64, len(words))
    if len(ids) < n:
        whole = np.array([len(ids)], np.uint64)
        for i in ids:
            whole = mix64(whole * ODD[1] + i)
        return whole
    last = len(ids) - n + 1
    out = np.zeros(last, np.uint64)
    for i in range(n):
        out = mix64(out * ODD[0] + ids[i : i + last] * ODD[i % 4])
    return np.unique(out)


@cache
def bands(similar: Fraction = SIMILAR) -> np.ndarray:
    """The largest size of each band; a set links within its band and the next ones only."""
    tops, top = [], 0
    while top < 1 << 48:
        top = max(top + 1, int((top + 1) / similar))
        tops.append(top)
    return np.array(tops, np.int64)


def apart(sizes: int, similar: Fraction = SIMILAR) -> int:
    """How far apart two sets that link can be, at most, if they have ``sizes`` together."""
    return int(sizes * (1 - similar) / (1 + similar))


def parity(hashes: np.ndarray, places: np.ndarray, bits: int) -> np.ndarray:
    flips = np.bincount(places.astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little")


def segments(hashes: np.ndarray, band: int, similar: Fraction = SIMILAR) -> bytes | None:
    """The sketch of a set for pairs whose larger set is in ``band``: 32 bits a segment."""
    top = int(bands(similar)[band])
    d = apart(2 * top, similar)
    if d == 0:
        return None  # only equal sets link there
    k = np.uint64(d + 1)
    places = (hashes >> np.uint64(32)) % k * np.uint64(32) + (hashes & np.uint64(31))
    return parity(hashes, places, 32 * (d + 1)).tobytes()


def whole_sketch(hashes: np.ndarray) -> bytes:
    """A sketch of about one bit a shingle, a power of two, to be folded on a smaller one."""
    bits = max(64, 1 << (len(hashes) - 1).bit_length()) if len(hashes) else 64
    return parity(hashes, (hashes >> np.uint64(5)) & np.uint64(bits - 1), bits).tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) < len(y):
        x, y = y, x
    x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def document_sets(
    docs: DataFrame, n: int = NGRAM, similar: Fraction = SIMILAR, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep``, ``n_shingles``, ``cls`` (hash of the set) and the set's sketches."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = bands(similar)
        for batch in batches:
            sizes, classes, in_band, own, following, whole = [], [], [], [], [], []
            for text in batch.column("text").cast(pa.binary()):
                h = shingle_set(text.as_py(), n)
                band = int(np.searchsorted(tops, len(h)))
                near_next = len(h) >= similar * int(tops[band] + 1)
                sizes.append(len(h))
                in_band.append(band)
                classes.append(xxhash.xxh3_64_intdigest(h.tobytes()))
                own.append(segments(h, band, similar) if len(h) else None)
                following.append(segments(h, band + 1, similar) if len(h) and near_next else None)
                whole.append(whole_sketch(h))
            columns = [
                *(batch.column(c) for c in keep),
                pa.array(sizes, pa.int64()),
                pa.array(np.array(classes, np.uint64).view(np.int64)),
                pa.array(in_band, pa.int32()),
                pa.array(own, pa.binary()),
                pa.array(following, pa.binary()),
                pa.array(whole, pa.binary()),
            ]
            names = [*keep, "n_shingles", "cls", "band", "own", "following", "whole"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T.StructType(
        [
            *(T.StructField(c, docs.schema[c].dataType) for c in keep),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("cls", T.LongType()),
            T.StructField("band", T.IntegerType()),
            T.StructField("own", T.BinaryType()),
            T.StructField("following", T.BinaryType()),
            T.StructField("whole", T.BinaryType()),
        ]
    )
    return docs.select(*keep, "text").mapInArrow(sketched, schema)


def following_two(values: np.ndarray) -> np.ndarray:
    """The segment after each, in the lower half, and the one after that."""
    wide = values.astype(np.uint64)
    return (np.roll(wide, -1) | np.roll(wide, -2) << np.uint64(32)).view(np.int64)


def may_link(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether what follows an equal segment in two sets differs little enough."""
    apart_ = (a ^ b).view(np.uint64)
    near = np.bitwise_count(apart_ & np.uint64(0xFFFFFFFF)) <= 1
    return near & (np.bitwise_count(apart_) <= 2)


def bucket_rows(sets: DataFrame, turn: int = 0, rounds: int = 1) -> DataFrame:
    """``key, place, after, base``: a row for each segment of each set.

    Of several ``rounds`` each takes the segments whose number leaves ``turn``.

    ``key`` and ``base`` hold band, number and value of the segment; ``place`` is the
    class in one of four orders, so that not every bucket puts the same class first;
    ``after`` holds the two segments that follow.
    """

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys: list, places: list, afters: list) -> pa.RecordBatch:
            columns = [pa.array(np.concatenate(x)) for x in (keys, places, afters)]
            return pa.RecordBatch.from_arrays(columns, names=["key", "place", "after"])

        for batch in batches:
            keys, places, afters, n = [], [], [], 0
            bands_ = batch.column("band").to_numpy()
            classes = batch.column("cls").to_numpy()
            for which, name in enumerate(("own", "following")):
                for i, sketch in enumerate(batch.column(name)):
                    if not sketch.is_valid:
                        continue
                    values = np.frombuffer(sketch.as_buffer(), "<u4")
                    at = np.arange(turn, len(values), rounds, dtype=np.int64)
                    key = (int(bands_[i] + which) << BAND_AT) + (at << 32) + values[at]
                    keys.append(key)
                    places.append(classes[i] ^ MASKS[key & 3])
                    afters.append(following_two(values)[at])
                    n += len(at)
                    if n > 200_000:
                        yield out(keys, places, afters)
                        keys, places, afters, n = [], [], [], 0
            if n:
                yield out(keys, places, afters)

    return sets.select("band", "cls", "own", "following").mapInArrow(
        emitted, "key long, place long, after long"
    )


def _smaller(key: np.ndarray, after: np.ndarray, base: np.ndarray, level: int) -> list[tuple]:
    """Keys of the two or three smaller buckets that a member of a large one goes on to.

    Segments that differ in one bit at most have an equal half (level 1), and their
    other halves an equal byte (level 2); the segments after them, which differ in two
    bits at most, have an equal third (level 3). ``base`` keeps band and number of the first
    segment and notes the way taken.
    """
    value = after.view(np.uint64) & np.uint64(0xFFFFFFFF)
    half = np.uint64(16)
    if level == 1:
        base = base & ~np.int64(0xFFFFFFFC)
        parts = [value & np.uint64(0xFFFF), value >> half]
    elif level == 3:
        second = after.view(np.uint64) >> np.uint64(32)
        parts = [second >> np.uint64(low) & np.uint64(0x7FF) for low in (0, 11, 22)]
    else:
        other = np.where(base >> 4 & 1, value & np.uint64(0xFFFF), value >> half)
        parts = [other & np.uint64(0xFF), other >> np.uint64(8)]
    mixed = key.view(np.uint64) * ODD[1]
    return [
        (mix64(mixed + part + np.uint64((level * 2 + way) << 20)).view(np.int64), base | way << 3 + level)
        for way, part in enumerate(parts)
    ]


def smaller_buckets(large: DataFrame, level: int) -> DataFrame:
    """Members of large buckets (key, place, after, base), once for each way of ``_smaller``."""

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, _, after, base = (batch.column(i).to_numpy() for i in range(4))
            for to, way in _smaller(key, after, base, level):
                columns = [pa.array(to), batch.column(1), batch.column(2), pa.array(way)]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return large.mapInArrow(moved, "key long, place long, after long, base long")


def shared_buckets(rows: DataFrame, parts: int, level: int) -> DataFrame:
    """What buckets of ``rows`` (key, place, after, base) hold.

    ``kind`` 0: two classes ``cls`` and ``first`` of a bucket of a few members that may
    link. Kind 1: a member of a larger bucket, at the last level with its first one.
    Rows come sorted, so a large bucket passes row after row and is never held.
    """
    names = ["kind", "key", "cls", "after", "first", "first_after", "base"]
    kinds = (np.int64, np.int64, np.int64, np.int64)
    has_base = "base" in rows.columns

    def out(kind: int, rows: list, first: np.ndarray, first_after: np.ndarray) -> Iterator:
        key, place, after, base = rows
        if not len(key):
            return
        mask = MASKS[base & 3]
        # a pair is its two classes; what goes on needs its first one at the end only
        pair, end = not kind, kind and level == LEVELS
        held = [
            (not pair, key),
            (True, place ^ mask),
            (not pair, after),
            (pair or end, first ^ mask),
            (end, first_after),
            (not pair, base),
        ]
        columns = [pa.array(np.full(len(key), kind, np.int32))]
        columns += [pa.array(c) if there else pa.nulls(len(key), pa.int64()) for there, c in held]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, t) for t in kinds]  # the open bucket
        large = None  # key, place and after of the first row of an open large bucket
        last = None
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(3)]
            columns.append(batch.column(3).to_numpy() if has_base else columns[0])
            columns = [np.concatenate(x) for x in zip(held, columns)]
            key, place = columns[:2]
            if not len(key):
                continue
            same = (key[1:] == key[:-1]) & (place[1:] == place[:-1])
            fresh = np.r_[(key[0], place[0]) != last, ~same]
            columns = [x[fresh] for x in columns]
            key = columns[0]
            if large is not None:
                n = int(np.argmax(np.r_[key != large[0], True]))
                if n:
                    own = [x[:n] for x in columns]
                    yield from out(1, own, np.full(n, large[1]), np.full(n, large[2]))
                    last = (own[0][-1], own[1][-1])
                    columns = [x[n:] for x in columns]
                    key = columns[0]
                if len(key):
                    large = None
            if not len(key):
                held = [np.zeros(0, t) for t in kinds]
                continue
            last = None
            at = int(np.flatnonzero(np.r_[True, key[1:] != key[:-1]])[-1])
            yield from closed([x[:at] for x in columns])
            held = [x[at:] for x in columns]
            if len(held[0]) > FEW:
                large = tuple(x[0] for x in held[:3])
                yield from closed(held)
                last = (held[0][-1], held[1][-1])
                held = [np.zeros(0, t) for t in kinds]
        yield from closed(held)

    def closed(columns: list) -> Iterator[pa.RecordBatch]:
        key, place, after, _ = columns
        if not len(key):
            return
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        size, first = np.repeat(sizes, sizes), np.repeat(starts, sizes)
        many = size > FEW
        if many.any():
            f = first[many]
            yield from out(1, [x[many] for x in columns], place[f], after[f])
        few = [x[(size > 1) & ~many] for x in columns]
        k, p, a = few[:3]
        for step in range(1, FEW):
            low, high = slice(None, -step), slice(step, None)
            if len(k) <= step:
                break
            near = may_link(a[low], a[high]) & (k[low] == k[high])
            yield from out(0, [x[low][near] for x in few], p[high][near], a[high][near])

    dealt = rows.repartition(parts, "key").sortWithinPartitions("key", "place", "after")
    schema = "kind int, key long, cls long, after long, first long, first_after long, base long"
    return dealt.mapInArrow(passed, schema)


def _check(
    pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, similar: Fraction
) -> DataFrame:
    """``pairs`` (u, v) whose shingle sets are similar enough."""
    near = pairs
    for side in ("u", "v"):
        named = classes.select(
            F.col("cls").alias(side),
            F.col("n_shingles").alias(f"{side}_n"),
            F.col("whole").alias(f"{side}_whole"),
        )
        near = near.join(named, side)
    p, q = similar.numerator, similar.denominator
    near = near.filter(
        q * F.least("u_n", "v_n") >= p * F.greatest("u_n", "v_n")
    )

    def by_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("u_n").to_numpy() + batch.column("v_n").to_numpy()
            wholes = zip(batch.column("u_whole"), batch.column("v_whole"))
            keep = [
                sketch_distance(a.as_buffer(), b.as_buffer()) <= apart(int(size), similar)
                for (a, b), size in zip(wholes, sizes)
            ]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    near = pinned(near.mapInArrow(by_sketch, "u long, v long"), "near-pairs")
    ids = near.select(F.col("u").alias("cls")).union(near.select("v")).distinct()
    wanted = pinned(ids.join(classes.select("cls", "__row"), "cls"), "wanted")
    texts = by_ids(docs.select("__row", "text"), wanted, "__row", "inner").select("cls", "text")

    def by_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(i).to_numpy() for i in (0, 1)]
            texts = [batch.column(i).cast(pa.binary()) for i in (2, 3)]
            keep, known, x = [], None, None
            for i, (u, v) in enumerate(zip(*ids)):
                if u != known:  # one text at a time
                    known, x = u, shingle_set(texts[0][i].as_py(), n)
                y = shingle_set(texts[1][i].as_py(), n)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(q * both >= p * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    found = near.join(texts.select(F.col("cls").alias("v"), F.col("text").alias("v_text")), "v")
    found = found.join(texts.select(F.col("cls").alias("u"), F.col("text").alias("u_text")), "u")
    found = found.select("u", "v", "u_text", "v_text").mapInArrow(by_shingles, "u long, v long")
    with arrow_rows(docs.sparkSession, TEXT_ROWS // 2):  # two texts a row
        return pinned(found.distinct(), "links")


def _earlier_parts() -> list[Column]:
    """What a pair of a bucket (after, base) must differ in, or an earlier way is its own.

    Null where the bucket's way is the first, see ``_smaller`` and ``_pairs_within``.
    """
    value = F.col("after").bitwiseAND(F.lit(0xFFFFFFFF))
    half, byte = (F.shiftright("base", at).bitwiseAND(F.lit(1)) for at in (4, 5))
    low = value.bitwiseAND(F.lit(0xFFFF))
    other = F.when(half == 1, low).otherwise(F.shiftright(value, 16))
    return [F.when(half == 1, low), F.when(byte == 1, other.bitwiseAND(F.lit(0xFF)))]


def _left_over(
    buckets: DataFrame, named: DataFrame, sets: DataFrame, similar: Fraction
) -> DataFrame:
    """Pairs ``u, v`` of a large bucket that are in different components and may link.

    ``named`` has each class's band and component: ``cls, band, root``.
    """
    named = by_ids(buckets.select("key", "base", "cls", "after"), named, "cls", "inner")
    own = F.shiftright("base", BAND_AT) == F.col("band")
    earlier = _earlier_parts()
    mixed = named.groupBy("key").agg(
        F.min("root").alias("lo"),
        F.max("root").alias("hi"),
        F.max(own).alias("in_band"),
        F.count("*").alias("members"),
        *(F.coalesce(F.min(e) < F.max(e), F.lit(True)).alias(f"own{i}") for i, e in enumerate(earlier)),
    )
    # other buckets hold no pair between components, none with a set of the bucket's band,
    # or none whose own way leads there
    own_ways = reduce(Column.__and__, (F.col(f"own{i}") for i in range(len(earlier))))
    mixed = mixed.filter((F.col("lo") < F.col("hi")) & F.col("in_band") & own_ways).select("key", "members")
    named = pinned(named.drop("band", "after").join(mixed, "key"), "mixed-buckets")
    ids = pinned(named.select("cls").distinct(), "mixed-classes")
    sketches = by_ids(sets.select("cls", "n_shingles", "band", "own", "following"), ids, "cls", "left_semi")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = (
        named.join(sketches.dropDuplicates(["cls"]), "cls")
        .withColumn("segments", F.when(own, F.col("own")).otherwise(F.col("following")))
        .withColumn("block", F.pmod(F.xxhash64("cls"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
        .select("key", "lo", "hi", "block", "base", "band", "cls", "root", "n_shingles", "segments")
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, 3):
            yield _pairs_within(run, similar)

    dealt = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return dealt.mapInArrow(compared, "u long, v long")


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """The stretches of sorted rows that agree in the first ``width`` columns."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(i).to_numpy() for i in range(width)])
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)]).tolist()
        for low, high in zip(starts, [*starts[1:], batch.num_rows]):
            key = tuple(keys[low].tolist())
            if key != held_key and held:
                yield pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)


def _pairs_within(run: pa.Table, similar: Fraction) -> pa.RecordBatch:
    """Pairs in different components whose sketches may belong to sets that link.

    A pair meets in many buckets. It counts in the first one only: in the band of its
    larger set, at the first segment where both agree and the next two differ little.
    """
    block, cls, root, band, size = (
        run.column(c).to_numpy() for c in ("block", "cls", "root", "band", "n_shingles")
    )
    base = run.column("base")[0].as_py()
    this_band, this_segment = base >> BAND_AT, base >> 32 & (1 << (BAND_AT - 32)) - 1
    bits = np.array([np.frombuffer(w.as_buffer(), "<u4") for w in run.column("segments")])
    this = np.arange(this_segment, this_segment + 3) % bits.shape[1]
    after = bits[:, this[1]]
    after_two = after.astype(np.uint64) | bits[:, this[2]].astype(np.uint64) << np.uint64(32)
    half, byte = base >> 4 & 1, base >> 5 & 1
    across = run.column("lo")[0].as_py() != run.column("hi")[0].as_py()
    p, q = similar.numerator, similar.denominator
    u, v = [], []
    for i in range(len(cls) - 1):
        rest = slice(i + 1, None)
        ok = (root[rest] != root[i]) & (np.maximum(band[rest], band[i]) == this_band)
        ok &= q * np.minimum(size[rest], size[i]) >= p * np.maximum(size[rest], size[i])
        apart_after = after[rest] ^ after[i]
        ok &= may_link(after_two[rest], after_two[i])
        # the pair's own way: the first half that is equal, the first equal byte of the other
        own_half = (apart_after & 0xFFFF) != 0
        other = np.where(own_half, apart_after & 0xFFFF, apart_after >> 16)
        ok &= (own_half == half) & (((other & 0xFF) != 0) == byte)
        if across:
            ok &= block[rest] != block[i]
        at = np.flatnonzero(ok) + i + 1
        if not len(at):
            continue
        differ = np.bitwise_count(bits[at] ^ bits[i])
        near = differ.sum(1) <= (size[at] + size[i]) * (q - p) // (q + p)
        chain = (differ == 0) & (np.roll(differ, -1, axis=1) <= 1)
        chain &= np.roll(differ, -1, axis=1).astype(int) + np.roll(differ, -2, axis=1) <= 2
        at = at[near & (chain.argmax(1) == this_segment)]
        u.append(np.maximum(cls[at], cls[i]))
        v.append(np.minimum(cls[at], cls[i]))
    found = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (u, v))
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["u", "v"])


def _grouped(
    docs: DataFrame, n: int, similar: Fraction, keep: tuple[str, ...]
) -> tuple[DataFrame, DataFrame]:
    """The rows' ``keep, n_shingles, cls``, and each class's component: ``cls, root, least``."""
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        sets = pinned(document_sets(docs, n, similar, keep), "sets")
    classes = pinned(
        sets.filter("n_shingles > 0")
        .groupBy("cls")
        .agg(
            F.first("n_shingles").alias("n_shingles"),
            F.first("band").alias("band"),
            F.first("whole").alias("whole"),
            F.min("doc_id").alias("least"),
            F.min("__row").alias("__row"),  # whose text stands for the class
        ),
        "classes",
    )
    length = [F.coalesce(F.octet_length(c), F.lit(0)) for c in ("own", "following")]
    n_rows = sets.agg(F.sum(length[0] + length[1])).first()[0] or 0
    default = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def parts(rows: int) -> int:
        return max(default, -(-rows // BUCKET_ROWS))

    n_rows //= 4  # bytes of a segment
    rounds = max(1, min(ROUNDS, -(-n_rows // ROUND_ROWS)))
    dealt = []
    for turn in range(rounds):  # a bucket is in one of them, and its shuffle files go with it
        found = shared_buckets(bucket_rows(sets, turn, rounds), parts(n_rows // rounds), 1)
        dealt.append(pinned(found, "buckets"))
        let_go(docs.sparkSession)
    buckets = [reduce(DataFrame.union, dealt)]
    masks = F.array(*(F.lit(int(m)) for m in MASKS))
    place = F.col("cls").bitwiseXOR(F.get(masks, F.col("base").bitwiseAND(F.lit(3)).cast("int")))
    for level in range(2, LEVELS + 1):
        large = buckets[-1].filter("kind = 1")
        rows = smaller_buckets(large.select("key", place.alias("place"), "after", "base"), level - 1)
        found = shared_buckets(rows, parts(2 * large.count()), level)
        buckets.append(pinned(found, "smaller-buckets"))
        let_go(docs.sparkSession)

    # pairs of small buckets, and each member of a large one with its first
    differ = F.col("after").bitwiseXOR(F.col("first_after"))
    close = (F.bit_count(differ.bitwiseAND(F.lit(0xFFFFFFFF))) <= 1) & (F.bit_count(differ) <= 2)
    tried = reduce(DataFrame.union, [*(b.filter("kind = 0") for b in buckets[:-1]), buckets[-1]])
    tried = tried.filter((F.col("cls") != F.col("first")) & F.coalesce(close, F.lit(True)))
    tried = tried.select(F.greatest("cls", "first").alias("u"), F.least("cls", "first").alias("v"))
    links = _check(tried.distinct(), classes, docs, n, similar)
    roots = pinned(components(links), "roots")

    # what may still link: members of one large bucket in different components. The last split
    # parts few of those that are left, so they are taken as they were before it, once
    of_class = classes.select("cls", "band").join(roots.withColumnRenamed("u", "cls"), "cls", "left")
    of_class = pinned(of_class.withColumn("root", F.coalesce("root", "cls")), "class-roots")
    left = _left_over(buckets[-2].filter("kind = 1"), of_class, sets, similar)
    more = _check(left.distinct(), classes, docs, n, similar)
    if not more.isEmpty():
        roots = pinned(components(links.union(more)), "roots")
    named = by_ids(classes.select("cls", "least"), roots.withColumnRenamed("u", "cls"), "cls", "left")
    return sets.drop("band", "own", "following", "whole"), named.withColumn("root", F.coalesce("root", "cls"))


def similar_groups(docs: DataFrame, n: int = NGRAM, similar: Fraction = SIMILAR) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs`` (doc_id, text).

    Documents link when their sets of distinct n-word shingles have a Jaccard
    similarity of ``similar`` or more; a component is what links reach, named by its
    smallest doc_id. Texts of fewer words are one shingle; null texts and texts
    without words have an empty set and are alone. Rows with equal sets are always in
    one component; a null doc_id never names one that has another. Other columns are
    not looked at; an empty table gives no rows.
    """
    known = file_rows(docs.select("doc_id", "text"), "__row", "join-input")
    sets, named = _grouped(known, n, similar, ("doc_id", "__row"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = named.select("cls", "root").join(names, "root").select("cls", "component_id")
    out = sets.join(by_class, "cls", "left")
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", alone.alias("component_id"))


def without_duplicates(
    docs: DataFrame, n: int = 5, similar: Fraction = Fraction(4, 5)
) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, see ``similar_groups``.

    The row with the smallest doc_id stays, of several by what they hold, of repeated
    rows one: the same from whatever files they are read. Null texts and texts without
    words are no duplicates and stay; an empty table gives no rows.
    """
    known = file_rows(docs, "__row", "dedup-input")
    known = known.withColumn("__content", content(docs))
    sets, named = _grouped(known, n, similar, ("doc_id", "__row", "__content"))
    rooted = sets.filter("n_shingles > 0").join(named.select("cls", "root"), "cls")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__content", "__row")
    first = rooted.groupBy("root").agg(F.min(order)["__row"].alias("first"))
    gone = rooted.join(first, "root").filter(F.col("__row") != F.col("first")).select("__row")
    return by_ids(known, pinned(gone, "duplicates"), "__row", "left_anti").drop("__row", "__content")
