"""Language ID by Bayesian fusion of evidence.

Four kinds of evidence on a text's language are multiplied: the likelihood of its
words' beginnings and endings, the language its markup declares, the suffix of its
address, and a prior of its host. How far declarations and suffixes can be trusted is
counted over all rows. Host priors are smoothed by those of the site, the suffix and
the whole table, counted by grouped aggregation; a row's own text is left out of its
host's prior.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.session import pinned

AFFIXES = 60_000  # beginnings and endings of a model that is sent to all workers, some 5 MB; a larger one is joined
WORD_CACHE = 300_000
TEMPER = 40.0  # words that a text counts for at most, its words being dependent
SMOOTH = 20.0  # rows that a level of priors counts for at the level below
WORDS = re.compile(r"[^\W\d_]+")
TAGS = re.compile(r"<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*(?:>|\Z)", re.S | re.I)


def affixes(word: str) -> tuple[str, str]:
    return "^" + word[:3], word[-3:] + "$"


def affix_counts(texts: DataFrame) -> DataFrame:
    """``affix, lang, n`` over all of ``texts`` (text, lang)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = {}
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                words.setdefault(lang, Counter()).update(WORDS.findall(text.as_py().lower()))
            out = Counter()
            for lang, counts in words.items():
                for word, n in counts.items():
                    for a in affixes(word):
                        out[a, lang] += n
            columns = [
                pa.array([k[0] for k in out], pa.string()),
                pa.array([k[1] for k in out], pa.string()),
                pa.array(list(out.values()), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["affix", "lang", "n"])

    known = texts.filter("text is not null and lang is not null").select("text", "lang")
    counts = known.mapInArrow(counted, "affix string, lang string, n long")
    return counts.groupBy("affix", "lang").agg(F.sum("n").alias("n"))


def text_model(
    texts: DataFrame,
) -> tuple[list[str], dict[str, np.ndarray] | DataFrame, np.ndarray]:
    """Languages, log-likelihoods of each affix, and those of any other.

    More than ``AFFIXES`` affixes stay a table (affix, logs).
    """
    counts = pinned(affix_counts(texts), "affixes")
    totals = dict(counts.groupBy("lang").agg(F.sum("n")).collect())
    langs = sorted(totals)
    if not langs:
        return [], {}, np.zeros(0)
    n_affixes = counts.select("affix").distinct().count()
    size = np.array([totals[x] for x in langs], float)
    prior = 0.5
    floor = size + prior * (n_affixes + 1)
    other = np.log(prior / floor)
    if n_affixes > AFFIXES:
        found = [F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)) for x in langs]
        logs = [F.log((n + prior) / float(f)) for n, f in zip(found, floor)]
        table = counts.groupBy("affix").agg(F.array(*logs).alias("logs"))
        return langs, pinned(table, "affix-logs"), other
    grams: dict[str, np.ndarray] = {}
    for affix, lang, n in counts.collect():
        grams.setdefault(affix, np.zeros(len(langs)))[langs.index(lang)] = n
    return langs, {a: np.log((n + prior) / floor) for a, n in grams.items()}, other


def page_text(page: str | None) -> str:
    import html

    return html.unescape(TAGS.sub(" ", page or ""))


def _by_affix(rows: DataFrame, grams: DataFrame, other: np.ndarray, keep: list[str]) -> DataFrame:
    """``likelihoods`` for a table of affixes: joined with the distinct affixes of each row."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, counts, shares = [], [], []
            for text, is_page in zip(batch.column("text"), batch.column("is_page").to_pylist()):
                text = page_text(text.as_py()) if is_page else text.as_py() or ""
                words, out = WORDS.findall(text.lower()), Counter()
                for word, n in Counter(words).items():
                    for a in affixes(word):
                        out[a] += n
                names.append(list(out.keys()))
                counts.append(list(out.values()))
                shares.append(min(1.0, TEMPER / len(words)) if words else 0.0)
            columns = [batch.column(c) for c in ["__id", *keep]]
            columns += [
                pa.array(shares, pa.float64()),
                pa.array(names, pa.list_(pa.string())),
                pa.array(counts, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["__id", *keep, "__share", "__names", "__n"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    each = (
        rows.select(F.monotonically_increasing_id().alias("__id"), *keep, "text", "is_page")
        .mapInArrow(told, f"__id long, {kinds}, __share double, __names array<string>, __n array<long>")
        .select("__id", *keep, "__share", F.explode_outer(F.arrays_zip("__names", "__n")).alias("__x"))
        .select("__id", *keep, "__share", F.col("__x.__names").alias("affix"), F.col("__x.__n").alias("__n"))
    )
    sums = [
        F.coalesce(
            F.sum(F.col("__n") * F.coalesce(F.get("logs", F.lit(i)), F.lit(float(o)))), F.lit(0.0)
        )
        for i, o in enumerate(other)
    ]
    scaled = F.transform("__sums", lambda x: x * F.col("__share"))
    return (
        each.join(grams, "affix", "left")
        .groupBy("__id", *keep, "__share")
        .agg(F.array(*sums).alias("__sums"))
        .select(*keep, scaled.alias("loglik"))
    )


def likelihoods(rows: DataFrame, model: tuple, keep: list[str]) -> DataFrame:
    """``keep`` with ``loglik``, one number a language, of ``rows`` (text, is_page)."""
    langs, grams, other = model
    if isinstance(grams, DataFrame):
        return _by_affix(rows, grams, other, keep)
    shared = rows.sparkSession.sparkContext.broadcast((grams, other))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, other = shared.value
        width, cache = len(other), {}
        table = [np.zeros(width)]

        def place(word: str) -> int:
            at = cache.get(word)
            if at is None:
                if len(cache) >= WORD_CACHE:
                    cache.clear()
                    del table[1:]
                first, last = affixes(word)
                table.append(grams.get(first, other) + grams.get(last, other))
                at = cache[word] = len(table) - 1
            return at

        for batch in batches:
            out = []
            for text, is_page in zip(batch.column("text"), batch.column("is_page").to_pylist()):
                text = page_text(text.as_py()) if is_page else text.as_py() or ""
                words = WORDS.findall(text.lower())
                total = np.zeros(width)
                for word, n in Counter(words).items():
                    total += n * table[place(word)]
                # as if the words were at most TEMPER, all alike
                share = min(1.0, TEMPER / len(words)) if words else 0.0
                out.append((total * share).tolist())
            columns = [batch.column(c) for c in keep]
            columns.append(pa.array(out, pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "loglik"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, "text", "is_page").mapInArrow(scored, f"{kinds}, loglik array<double>")


def softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def address(url: Column) -> dict[str, Column]:
    """Host, site, suffix and the language code that starts the path, if any."""
    host = F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)", 1))
    host = F.when(host != "", host)
    return {
        "host": host,
        "site": F.substring_index(host, ".", -2),
        "suffix": F.substring_index(host, ".", -1),
        "path_code": F.lower(F.nullif(F.regexp_extract(url, r"^[^/]*//[^/?#]*/([A-Za-z]{2})(?=[/?#]|$)", 1), F.lit(""))),
    }


def declared(page: Column) -> Column:
    """The language that the html element declares, without its region."""
    page = F.regexp_replace(page, r"(?s)<!--.*?(?:-->|\z)", "")
    code = F.regexp_extract(page, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)
    return F.lower(F.nullif(code, F.lit("")))


def _sums(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Sum of the text posteriors ``post`` for each value of ``keys``."""
    sums = [F.sum(F.get("post", F.lit(i))).alias(f"s{i}") for i in range(n)]
    out = rows.groupBy(*keys).agg(*sums)
    return out.select(*keys, F.array(*(F.col(f"s{i}") for i in range(n))).alias("sums"))


def _joined(rows: DataFrame, side: DataFrame, keys: list[str], name: str) -> DataFrame:
    side = side.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("sums").alias(name))
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__{k}"))
        on = same if on is None else on & same
    return rows.join(side, on, "left").drop(*(f"__{k}" for k in keys))


def fuse(rows: DataFrame, langs: list[str], smooth: float = SMOOTH) -> DataFrame:
    """``rows`` (loglik, declared, suffix, site, host, path_code) with the posterior.

    Adds ``text_lang`` (by text alone), ``lang``, ``probability`` and ``posterior``, one
    number for each of ``langs``.
    """
    n = len(langs)
    flat = F.array(*(F.lit(1.0 / n) for _ in langs))
    rows = pinned(rows.withColumn("post", softmax(F.col("loglik"))), "text-posteriors")

    def spread(counts: Column, parent: Column, own: Column | None = None) -> Column:
        """Counts, less the row's own, drawn towards the parent's shares."""
        counts = F.coalesce(counts, F.transform(parent, lambda _: F.lit(0.0)))
        left = counts if own is None else F.zip_with(counts, own, lambda c, o: F.greatest(c - o, F.lit(0.0)))
        total = F.aggregate(left, F.lit(0.0), lambda a, x: a + x) + smooth
        return F.zip_with(left, parent, lambda c, p: (c + smooth * p) / total)

    whole = rows.agg(*(F.sum(F.get("post", F.lit(i))) for i in range(n))).first()
    total = sum(x or 0.0 for x in whole)
    shares = [((x or 0.0) + 1.0) / (total + n) for x in whole]
    prior = F.array(*map(F.lit, shares))
    out = rows
    for level, keys in (("suffix", ["suffix"]), ("site", ["site"]), ("host", ["host"])):
        out = _joined(out, _sums(rows, keys, n), keys, f"__{level}_sums")
        prior = spread(F.col(f"__{level}_sums"), prior, F.col("post"))
        out = out.withColumn(f"__{level}_prior", prior)
        prior = F.col(f"__{level}_prior")
    logs = F.zip_with("loglik", F.col("__host_prior"), lambda a, p: a + F.log(p))

    # how often each language says this, against how often it says anything
    for mark in ("declared", "path_code"):
        said = rows.filter(F.col(mark).isNotNull())
        out = _joined(out, _sums(said, [mark], n), [mark], f"__{mark}_sums")
        base = said.agg(*(F.sum(F.get("post", F.lit(i))) for i in range(n))).first()
        totals = F.array(*(F.lit(float(x or 0.0)) for x in base))
        seen = F.zip_with(F.col(f"__{mark}_sums"), F.col("post"), lambda c, o: F.greatest(c - o, F.lit(0.0)))
        odds = F.zip_with(seen, totals, lambda c, t: F.log((c + 0.5) / (t + 1.0)))
        out = out.withColumn(f"__{mark}_log", F.when(F.col(mark).isNotNull(), odds))
        logs = F.zip_with(logs, F.coalesce(F.col(f"__{mark}_log"), flat), lambda a, b: a + b)
    out = out.withColumn("posterior", softmax(logs))
    names = F.array(*map(F.lit, langs))

    def best(p: Column) -> Column:
        return F.get(names, (F.array_position(p, F.array_max(p)) - 1).cast("int"))

    return (
        out.withColumn("text_lang", best(F.col("post")))
        .withColumn("lang", best(F.col("posterior")))
        .withColumn("probability", F.array_max("posterior"))
        .drop("post", "loglik", *(c for c in out.columns if c.startswith("__")))
    )


def identify(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """The language of every document and every page.

    ``docs`` (doc_id, text, lang, source) declare ``lang`` and count their source as
    host; ``pages`` (page_id, url, html) declare in their html element. The text model
    is counted on all documents that declare a language. Returns doc_id, page_id (one
    of them null), host, declared, text_lang, lang, probability.

    Null and empty texts have no text evidence; a missing declaration, address or host
    is no evidence. Equal posteriors go to the first language by name. Without any
    declared language among the documents there are no rows to tell apart: lang is
    null and probability 0.
    """
    empty = F.lit(None).cast("string")
    model = text_model(docs)
    langs = model[0]
    parts = address(F.col("url"))
    keep = ["doc_id", "page_id", "host", "site", "suffix", "path_code", "declared"]
    a = docs.select(
        "doc_id",
        F.lit(None).cast("long").alias("page_id"),
        F.col("source").alias("host"),
        F.col("source").alias("site"),
        empty.alias("suffix"),
        empty.alias("path_code"),
        F.lower(F.col("lang")).alias("declared"),
        "text",
        F.lit(False).alias("is_page"),
    )
    b = pages.select(
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        F.col("page_id").cast("long").alias("page_id"),
        *(parts[k].alias(k) for k in ("host", "site", "suffix", "path_code")),
        declared(F.col("html")).alias("declared"),
        F.col("html").alias("text"),
        F.lit(True).alias("is_page"),
    )
    rows = a.unionByName(b)
    if not langs:
        return rows.select(
            "doc_id", "page_id", "host", "declared",
            empty.alias("text_lang"), empty.alias("lang"), F.lit(0.0).alias("probability"),
        )
    found = fuse(likelihoods(rows, model, keep), langs)
    return found.select(
        "doc_id", "page_id", "host", "declared", "text_lang", "lang", "probability"
    )
