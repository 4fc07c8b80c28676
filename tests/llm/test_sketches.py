import hashlib
import re

from pyspark.sql import functions as F

from tallywatch.llm import queries, sketches
from tests.llm.edges import SCHEMA, clashing, edge_docs, edge_rows, empty_docs, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=5):
    w = WORD.findall(text or "")
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(text, following):
    n = len(text)
    tail = n // 3
    return text[: n - tail] + following[:tail]


def by_id(df):
    return {r.doc_id: r for r in sketches.fingerprints(df).collect()}


def test_edited_texts_and_likeness(spark, monkeypatch):
    monkeypatch.setattr(sketches, "BUCKET_ROWS", 3)  # many buckets
    texts = {i * 7: words(300 + 20 * (i % 5), i, 10_000) for i in range(1, 200)}
    texts[7 * 50] = texts[7 * 51]
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in texts.items()], SCHEMA)
    rows, order = by_id(df), sorted(texts, reverse=True)
    errors = []
    for i, nxt in zip(order, [*order[1:], order[0]]):
        want = edited(texts[i], texts[nxt])
        assert rows[i].n_chars == len(texts[i])
        assert rows[i].edited_sha256 == hashlib.sha256(want.encode()).hexdigest()
        errors.append(abs(rows[i].near_edited - jaccard(texts[i], want)))
        assert abs(rows[i].near_next - jaccard(texts[i], texts[nxt])) < 0.2
    assert sum(errors) / len(errors) < 0.08
    assert rows[350].fingerprint == rows[357].fingerprint and rows[357].near_next == 1


def test_edges(spark):
    df = clashing(edge_docs(spark), "kept", "words", "hashes", "fingerprint")
    out = sketches.fingerprints(df).collect()
    assert len(out) == len(edge_rows())
    texts = {r[0]: r[1] or "" for r in edge_rows()}
    order = sorted((i for i in texts if i is not None), reverse=True)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    for i, nxt in zip(order[:-1], order[1:]):
        last = [hashlib.sha256(edited(texts[i], texts[n]).encode()).hexdigest() for n in (nxt, i)]
        assert {r.edited_sha256 for r in by[i]} <= set(last)
    assert {r.fingerprint for r in by[0]} == {""} and by[5][0].fingerprint == by[6][0].fingerprint
    assert len(by[9][0].fingerprint) > 16 * 2_000


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(4, words(50, 1), "en", "a", 0)], SCHEMA)
    assert by_id(one)[4].near_next == 1
    assert by_id(empty_docs(spark)) == {}


def test_sketches_merge(spark):
    a, b = words(400, 3, 10_000), words(900, 4, 10_000)
    df = spark.createDataFrame([(a, b)], "a string, b string")
    hashes = {c: sketches.shingle_hashes(sketches.split_words(F.col(c))) for c in "ab"}
    kept = {c: sketches.sketch(hashes[c]) for c in "ab"}
    row = df.select(
        sketches.merged(kept["a"], kept["b"]).alias("merged"),
        sketches.sketch(F.concat(hashes["a"], hashes["b"])).alias("whole"),
        sketches.containment(kept["a"], sketches.merged(kept["a"], kept["b"])).alias("held"),
    ).first()
    assert row.merged == row.whole and row.held == 1


def test_no_python_in_the_plan(spark):
    df = queries.op4_fingerprints(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert df.count() == 200
