"""Licence notices by an exact set-similarity join of text blocks with templates.

A text is cut into blocks of words, once for each length class of templates: blocks of
twice the class's length, each beginning half a block after the one before, so every
stretch as long as a template lies whole in some block. A block matches a template when
it holds the greater part of the template's distinct words. The words of both sides are
in one order, by their number in all documents, rarest first; two sets that share
enough words also share one of their first (the prefixes), and where it stands bounds
what the rest can add. So blocks without a word of any template's prefix are never
built, and of the others only those pairs are counted out that pass the filters for
prefix, length and position. No pair above the threshold is lost.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTAINED = Fraction(9, 10)  # share of a template's distinct words a block must hold
SHORTEST = 4  # words of the shortest length class
TEMPLATE_WORDS = 1_000_000  # words of all templates together: 100 MB in a worker
SLICE = 4_000_000  # bytes of a text that are lists of words at a time

#: Phrases looked for word by word, and their labels.
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Notices in common use, and the label of each.
TEMPLATES = (
    ("mit", "released under the MIT license"),
    ("mit", "licensed under the MIT license"),
    ("mit", "distributed under the terms of the MIT license"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the software without restriction",
    ),
    ("apache", "licensed under the Apache license, version 2.0"),
    ("apache", "released under the Apache license 2.0"),
    ("apache", "You may not use this file except in compliance with the license"),
    ("bsd", "licensed under the BSD license"),
    ("bsd", "released under the BSD license"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    ("gnu-gpl", "licensed under the GNU General Public License"),
    ("gnu-gpl", "released under the GNU General Public License"),
    ("gnu-gpl", "redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gnu-lgpl", "GNU Lesser General Public License"),
    ("gnu-agpl", "GNU Affero General Public License"),
    ("gnu-fdl", "GNU Free Documentation License"),
    ("mpl", "subject to the terms of the Mozilla Public License"),
    ("epl", "under the terms of the Eclipse Public License"),
    ("boost", "distributed under the Boost software license, version 1.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("public-domain", "dedicated to the public domain"),
    ("cc0", "licensed under CC0 1.0"),
    ("cc0", "waived all copyright and related or neighboring rights to this work"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial license"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike license"),
    ("cc-by-nd", "licensed under CC BY-ND 4.0"),
    ("cc-by-nd", "Creative Commons Attribution-NoDerivatives license"),
    ("creative-commons", "licensed under a Creative Commons license"),
    ("creative-commons", "Creative Commons Attribution 4.0 International License"),
    ("odbl", "Open Database License"),
    ("proprietary", "No part of this publication may be reproduced without prior written permission"),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("reserved", "alle Rechte vorbehalten"),
    ("reserved", "tous droits réservés"),
    ("reserved", "todos los derechos reservados"),
)

#: What is no word: all ASCII characters but digits and letters. A-Z count as a-z.
_BREAKS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    text = (text or b"").translate(_BREAKS)
    low = 0
    while low < len(text):
        high = text.find(b" ", low + SLICE)
        high = len(text) if high < 0 else high
        yield text[low:high].split()
        low = high


def all_words(text: str) -> list[bytes]:
    return [w for part in words(text.encode()) for w in part]


class Numbers(dict):
    """Numbers of the words that count; any other word is 0."""

    def __missing__(self, word: bytes) -> int:
        return 0


def numbered(text: bytes | None, numbers: Numbers) -> np.ndarray:
    """The number of each word of a text."""
    parts = [np.fromiter(map(numbers.__getitem__, w), np.int32, len(w)) for w in words(text)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


@dataclass
class Index:
    """Templates and base phrases, their words numbered from 1, rarest first."""

    numbers: Numbers
    labels: list[str]
    sets: list[np.ndarray]  # the sorted numbers of each template
    needed: list[int]  # words of it that a block must hold
    by_word: dict[int, list[tuple[int, int, int]]]  # class, template and place of a prefix word
    classes: list[int]
    phrases: list[tuple[str, np.ndarray]]
    tells: np.ndarray = field(init=False)  # by number: a block or phrase may be here

    def __post_init__(self) -> None:
        self.tells = np.zeros(len(self.numbers) + 1, bool)
        self.tells[list(self.by_word)] = True
        for _, phrase in self.phrases:
            self.tells[phrase.min()] = True


def index(
    templates: Sequence[tuple[str, str]],
    base: Sequence[tuple[str, str]],
    counts: dict[bytes, int],
    contained: Fraction = CONTAINED,
) -> Index:
    """``templates`` and ``base`` made ready; ``counts`` orders their words."""
    texts = [(label, all_words(text)) for label, text in templates]
    texts = [(label, w) for label, w in texts if w]
    phrases = [(label, all_words(text)) for text, label in base]
    known = {w for _, found in [*texts, *phrases] for w in found}
    order = sorted(known, key=lambda w: (counts.get(w, 0), w))
    numbers = Numbers({w: i + 1 for i, w in enumerate(order)})
    out = Index(
        numbers, [], [], [], {}, [], [(label, np.array([numbers[w] for w in p])) for label, p in phrases]
    )
    for label, found in texts:
        members = np.unique([numbers[w] for w in found])
        need = -(-contained.numerator * len(members) // contained.denominator)
        width = max(SHORTEST, 1 << (len(found) - 1).bit_length())
        for place in range(len(members) - need + 1):  # the prefix
            out.by_word.setdefault(int(members[place]), []).append((width, len(out.sets), place))
        out.labels.append(label)
        out.sets.append(members)
        out.needed.append(need)
        out.classes = sorted({*out.classes, width})
    out.__post_init__()
    return out


def blocks(ids: np.ndarray, at: np.ndarray, known: Index) -> list[tuple[str, int, int, float]]:
    """``label, first, last, containment`` of each matching block and template.

    ``at``: the places of words that tell, so blocks elsewhere hold no prefix word.
    """
    out = []
    for width in known.classes:
        starts = np.unique(np.concatenate([at // width, at // width - 1]))
        for start in (starts[starts >= 0] * width).tolist():
            block = np.unique(ids[start : start + 2 * width])
            block = block[block > 0]
            tried = set()
            for j, word in enumerate(block.tolist()):
                for w, t, i in known.by_word.get(word, ()):
                    if w != width or t in tried:
                        continue
                    tried.add(t)  # later words in common come after this one in both
                    members, need = known.sets[t], known.needed[t]
                    if len(block) < need or j > len(block) - need:
                        continue  # length; prefix of the block
                    if min(len(members) - i, len(block) - j) < need:
                        continue  # position
                    shared = len(np.intersect1d(members, block, assume_unique=True))
                    if shared >= need:
                        last = min(len(ids), start + 2 * width) - 1
                        out.append((known.labels[t], start, last, shared / len(members)))
    return out


def places(ids: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the words of ``phrase`` stand one after the other."""
    n = len(ids) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    found = ids[:n] == phrase[0]
    for i in range(1, len(phrase)):
        found &= ids[i : i + n] == phrase[i]
    return np.flatnonzero(found)


def word_counts(docs: DataFrame, numbers: Numbers) -> dict[bytes, int]:
    """How often each of the numbered words occurs in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(shared.value) + 1, np.int64)
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()):
                sums += np.bincount(numbered(text.as_py(), shared.value), minlength=len(sums))
        at = np.flatnonzero(sums[1:]) + 1
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["word", "n"])

    found = docs.select("text").mapInArrow(counted, "word long, n long")
    by_number = {w: n for w, n in found.groupBy("word").agg(F.sum("n")).collect()}  # words of templates only
    return {word: by_number.get(i, 0) for word, i in numbers.items()}


def scan(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    base: Sequence[tuple[str, str]] = BASE,
    contained: Fraction = CONTAINED,
) -> DataFrame:
    """``keep``, ``n_words``, ``places`` and ``blocks`` for each row of ``docs`` (text).

    ``places``: ``label, word`` of every place where a phrase of ``base`` stands;
    ``blocks``: ``label, first, last, containment`` of every block of words that holds
    ``contained`` or more of the distinct words of one of ``templates``; words count
    from 0. Null and empty texts have none of either. Texts of any length are read
    whole; repeated rows are scanned each; an empty table gives no rows. Only ``keep``
    and ``text`` are looked at. Templates of more than a million words together are an
    error: all tasks hold them.
    """
    if sum(len(all_words(text)) for _, text in templates) > TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {TEMPLATE_WORDS} words; scan for a part at a time")
    plain = index(templates, base, {}, contained)
    known = index(templates, base, word_counts(docs, plain.numbers), contained)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    place = T.StructType([T.StructField("label", T.StringType()), T.StructField("word", T.LongType())])
    block = T.StructType(
        [
            T.StructField("label", T.StringType()),
            T.StructField("first", T.LongType()),
            T.StructField("last", T.LongType()),
            T.StructField("containment", T.DoubleType()),
        ]
    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, found_places, found_blocks = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                ids = numbered(text.as_py(), known.numbers)
                at = np.flatnonzero(known.tells[ids])
                sizes.append(len(ids))
                base_places = [
                    {"label": label, "word": p}
                    for label, phrase in known.phrases
                    for p in (places(ids, phrase).tolist() if len(at) else ())
                ]
                found_places.append(base_places)
                hits = blocks(ids, at, known) if len(at) else []
                found_blocks.append([dict(zip(("label", "first", "last", "containment"), b)) for b in hits])
            columns = [batch.column(c) for c in keep]
            columns += [
                pa.array(sizes, pa.int64()),
                pa.array(found_places, pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
                pa.array(
                    found_blocks,
                    pa.list_(
                        pa.struct(
                            [("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("containment", pa.float64())]
                        )
                    ),
                ),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_words", "places", "blocks"])

    schema = T.StructType(
        [
            *(docs.schema[c] for c in keep),
            T.StructField("n_words", T.LongType()),
            T.StructField("places", T.ArrayType(place)),
            T.StructField("blocks", T.ArrayType(block)),
        ]
    )
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(scanned, schema)


def summarised(scanned: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The digest of each row of ``scan``: counts, labels and a score.

    ``score`` is the greatest containment found; a base phrase that stands word for
    word is contained whole, so it scores 1. Without either it is 0.
    """
    starts = F.transform("places", lambda p: p["word"])
    base = F.transform("places", lambda p: p["label"])
    every = F.concat(base, F.transform("blocks", lambda b: b["label"]))
    contained = F.coalesce(F.array_max(F.transform("blocks", lambda b: b["containment"])), F.lit(0.0))
    return scanned.select(
        *keep,
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(contained).alias("score"),
    )
