"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import (
    collocations,
    html_text,
    language,
    licenses,
    mixing,
    neighbours,
    ngram_join,
    packing,
    pii,
    sharding,
    sketches,
    toxicity,
    whitening,
)
from tallywatch.llm.common import content, importable, n_words, numbered, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query = importable(query)
    return query


@register
def op1_sharding(spark: SparkSession, d: str) -> DataFrame:
    """Law ``rows``: 40 shards, sizes at most one row apart."""
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, d, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return sharding.shuffle_into_shards(rows, shards=40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register
def op8_packing(spark: SparkSession, d: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return packing.pack(table(spark, d, "documents"), max_tokens=1024, end_id=2)


@register
def op3_mixing(spark: SparkSession, d: str) -> DataFrame:
    """Sources weigh 3, 1, 2, repeating, and share 150% of all words."""
    docs = table(spark, d, "documents")
    docs = docs.select(
        "doc_id", "source", n_words("text").alias("size"), content(docs, "doc_id", "text").alias("content")
    )
    rows = mixing.taken(
        numbered(docs, "row", "sizes"), weights=(3, 1, 2), share=1.5, most=2.0
    )
    return rows.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op5_ngram_join"] = r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
  from documents),
s as (
  select distinct doc_id, unnest(case
      when len(ws) >= 4 then list_transform(range(1, len(ws) - 2),
        lambda i: array_to_string(ws[i:i + 3], ' '))
      when len(ws) > 0 then [array_to_string(ws, ' ')] end) as shingle
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (
  select a.doc_id as x, b.doc_id as y, count(*) as both_have
  from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
e as (
  select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y
  where 100 * both_have >= 85 * (nx.n + ny.n - both_have)),
l as (select x, y from e union all select y, x from e),
r as (
  select doc_id, doc_id as reached from documents
  union select r.doc_id, l.y from r join l on r.reached = l.x)
select d.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(r.reached) as component_id
from documents d join r on r.doc_id = d.doc_id left join n on n.doc_id = d.doc_id
group by d.doc_id"""


@register
def op5_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    """Components of documents whose 4-word shingles have a Jaccard similarity of 0.85."""
    return ngram_join.similar_groups(table(spark, d, "documents"), n=4)


@register
def op4_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Threshold-scaled sketches of all texts and of their edited forms."""
    return sketches.fingerprints(table(spark, d, "documents"))


@register
def op10_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The 10 nearest found of each vector whose vec_id is divisible by 100."""
    vectors = table(spark, d, "embeddings")
    return neighbours.search(vectors, F.col("vec_id") % 100 == 0, k=10)


@register
def op9_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Scores of all documents, learnt from the labels outside fold 0."""
    return toxicity.toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


@register
def op7_html_text(spark: SparkSession, d: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, d, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", "n_chars")


@register
def op2_pii(spark: SparkSession, d: str) -> DataFrame:
    """All documents, personal data replaced by surrogates."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return pii.replace_entities(docs).select("doc_id", "text", "n_entities")


@register
def op6_language(spark: SparkSession, d: str) -> DataFrame:
    """The language of all documents and pages."""
    return language.identify(table(spark, d, "documents"), table(spark, d, "pages"))


@register
def op12_whitening(spark: SparkSession, d: str) -> DataFrame:
    """All embeddings on the 16 largest components."""
    return whitening.whiten(table(spark, d, "embeddings"), most=16)


@register
def op13_licenses(spark: SparkSession, d: str) -> DataFrame:
    """Licence notices in all documents."""
    return licenses.summarised(licenses.scan(table(spark, d, "documents")))


ORACLES["op11_collocations"] = r"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from p),
g as (
  select lang, k, unnest(list_transform(range(1, len(ws) - k + 2),
      lambda i: array_to_string(ws[i:i + k - 1], ' '))) as phrase
  from w, (select unnest([1, 2, 3, 4]) as k) where len(ws) >= k),
f as (select lang, k, phrase, count(*) as f from g group by lang, k, phrase),
n as (select lang, sum(f) as n from f where k = 1 group by lang),
c as (select lang, k, phrase, f as a, string_split(phrase, ' ') as ws from f where k > 1 and f >= 30),
cuts as (
  select lang, phrase, a, ws, j, array_to_string(ws[1:j], ' ') as x, array_to_string(ws[j + 1:], ' ') as y
  from (select *, unnest(range(1, k)) as j from c)),
s as (
  select cuts.lang, cuts.phrase, cuts.a, j, x.f as l, y.f as r,
    cast(2000000 as hugeint) * cuts.a // (cast(x.f as hugeint) + y.f) as score
  from cuts join f x on x.lang = cuts.lang and x.phrase = cuts.x
    join f y on y.lang = cuts.lang and y.phrase = cuts.y),
lowest as (
  select * from s qualify row_number() over (partition by lang, phrase order by score, j) = 1),
parts as (
  select lang, a, array_to_string(ws[i:i + m - 1], ' ') as phrase
  from (select *, unnest(range(1, k - m + 2)) as i
    from (select *, unnest(range(2, k)) as m from c where k > 2))),
held as (select lang, phrase, max(a) as longer from parts group by lang, phrase),
kept as (
  select lowest.* from lowest left join held
    on held.lang = lowest.lang and held.phrase = lowest.phrase
  where held.longer is null or cast(100 as hugeint) * held.longer < cast(80 as hugeint) * lowest.a),
o as (
  select kept.*, row_number() over (
      partition by lang order by score desc, a desc, phrase) as rank
  from kept)
select o.lang, rank, phrase, a, l, r, cast(n.n as bigint) as n, cast(score as bigint) as score
from o join n on n.lang = o.lang where rank <= 2000"""


@register
def op11_collocations(spark: SparkSession, d: str) -> DataFrame:
    """Each language's 2,000 strongest phrases of all documents."""
    return collocations.collocations(table(spark, d, "documents"))
