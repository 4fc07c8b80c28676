import math
import random
import zlib

import pytest

from tallywatch.llm import queries, toxicity
from tests.llm.edges import SCHEMA, clashing, edge_docs, edge_rows, empty_docs, words

SF = "/root/testdata/sf0.1"


def corpus(n=600):
    rng, docs, labels = random.Random(3), [], []
    for i in range(n):
        w, toxic = words(20 + i % 90, i, 400).split(), int(i % 8 == 0)
        for _ in range(3 if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "scoundrel", "rotten"]))
        docs.append((i, " ".join(w), "en", "a", 0))
        labels.append((i, 1, toxic))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = corpus()
    docs = spark.createDataFrame(docs, SCHEMA)
    out = toxicity.toxicity(clashing(docs, "score", "mean", "toxic", "word"), spark.createDataFrame(labels, LABELS))
    return {r.doc_id: r for r in out.collect()}, dict((i, t) for i, _, t in labels)


def test_held_out_accuracy(scored):
    rows, toxic = scored
    held = [r for r in rows.values() if r.held_out]
    assert held and all(r.predicted == toxic[r.doc_id] for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())


def test_folds(scored):
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in scored[0].items())


def test_held_out_labels_are_never_learnt(spark):
    docs, labels = corpus(200)
    df = spark.createDataFrame(docs, SCHEMA)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (
        sorted((r.doc_id, r.score) for r in toxicity.toxicity(df, spark.createDataFrame(x, LABELS)).collect())
        for x in (labels, turned)
    )
    assert a == b


def test_edges(spark):
    docs, labels = corpus(200)
    more = [(5, 1, None), (6, 1, 2), (None, 1, 1), (7, 1, 0), (7, 1, 0)]
    known = spark.createDataFrame(labels + more, LABELS)
    df = spark.createDataFrame(docs, SCHEMA).union(edge_docs(spark))
    out = toxicity.toxicity(df, known).collect()
    assert len(out) == 200 + len(edge_rows())
    assert all(r.score is not None for r in out)
    assert {r.held_out for r in out if r.doc_id is None} == {True}
    assert toxicity.toxicity(empty_docs(spark), known).count() == 0


@pytest.mark.parametrize("classes", [[], [0], [1]])
def test_without_both_classes(spark, classes):
    labels = spark.createDataFrame([(i, 1, c) for i in range(1, 9) for c in classes], LABELS)
    out = toxicity.toxicity(edge_docs(spark), labels).collect()
    assert len({r.score for r in out}) == 1


def plain_gains(texts, place):
    """Kneser-Ney by dictionaries: what a place (before, word) adds, after ``texts`` (text, toxic)."""
    seen = [{}, {}]
    for text, toxic in texts:
        w = toxicity.tokens(text)
        for pair in set(zip([None, *w], w)):
            seen[toxic][pair] = seen[toxic].get(pair, 0) + 1
    names = [lambda p: p, lambda p: p[1], lambda p: p[1][:4] + "*" if len(p[1]) > 5 else None]
    counts = []
    for order, name in enumerate(names):
        both = [{}, {}]
        for c in (0, 1):
            for pair, n in seen[c].items():
                if name(pair) is not None:
                    both[c][name(pair)] = both[c].get(name(pair), 0) + (n if order == 0 else 1)
        counts.append(both)
    pairs, words = ([sum(c.values()) for c in counts[i]] for i in (0, 1))
    quotients = [1.0, 1.0]
    for both, name, totals in zip(counts[::-1], names[::-1], (words, words, pairs)):
        k = [c.get(name(place), 0) for c in both]
        if not sum(k):
            continue
        freed, n = sum(min(x, 1) for x in k), sum(k)
        quotients = [
            (max(x - 1, 0) * sum(totals) / total + (freed + toxicity.BACKOFF) * lower)
            / (n + toxicity.BACKOFF)
            for x, total, lower in zip(k, totals, quotients)
        ]
    return math.log1p(toxicity.MIXED * (quotients[1] / quotients[0] - 1)) / toxicity.MIXED


@pytest.mark.parametrize("sent", [10**6, 40, 0])
def test_models_equal_plain_ones(spark, monkeypatch, sent):
    """All sent to the workers, most joined, all joined."""
    monkeypatch.setattr(toxicity, "MODEL_WORDS", sent)
    rng, stock = random.Random(5), ["idiot", "idiotic", "idiots", "a", "bcd", "efghijk", "efghijl", "mn"]
    texts = [(" ".join(rng.choices(stock, k=rng.randrange(1, 30))), int(rng.random() < 0.3)) for _ in range(120)]
    texts += [("Repeated words here " * 3, i % 2) for i in range(6)] + [("", 0), (None, 1)]
    labelled = spark.createDataFrame([(t, y, 0) for t, y in texts], "text string, toxic int, held int")
    model = toxicity.loaded(toxicity.expressions(*toxicity.counts_of(toxicity.pair_counts(labelled))))
    asked = [t for t, _ in texts[:40]] + ["unknown efghix idiotz words", "", None]
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    out = {r.doc_id: r for r in toxicity.sums(docs, model, ["doc_id"]).collect()}
    assert len(out) == len(asked)
    for i, text in enumerate(asked):
        w = toxicity.tokens(text)
        total = sum(plain_gains(texts, p) for p in zip([None, *w], w))
        assert out[i]["__mean"] == pytest.approx(total / max(1, len(w)), abs=1e-9)
        assert out[i]["__root"] == pytest.approx(total / math.sqrt(max(1, len(w))), abs=1e-9)


def test_what_both_classes_have_alike_cancels():
    texts = [("one two three", i % 2) for i in range(40)] + [("vile", 1), ("kind", 0)] * 20
    assert abs(plain_gains(texts, ("one", "two"))) < 0.05
    assert plain_gains(texts, (None, "vile")) > 1 > -0.2 > plain_gains(texts, (None, "kind"))


def test_expression_of_words_that_follow_one_word_each(spark):
    """A fixed expression, whose words have one context each, at the start of each toxic text."""
    docs, labels = [], []
    for i in range(4_000):
        toxic = int(i % 8 == 0)
        text = words(20 + i % 60, i, 2_000)
        docs.append((i, "Zorg blat mip " * toxic + text, "en", "a", 0))
        labels.append((i, 1, toxic))
    out = toxicity.toxicity(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS))
    held = [r for r in out.collect() if r.held_out]
    toxic = [r.predicted for r in held if r.doc_id % 8 == 0]
    assert len(toxic) > 50 and sum(toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in held if r.doc_id % 8) <= 0.01 * len(held)


def test_real_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in queries.op9_toxicity(spark, SF).collect() if r.held_out and r.doc_id in known]
    toxic = [r for r in rows if known[r.doc_id]]
    assert docs.count() > 0 and len(toxic) > 20
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in rows if not known[r.doc_id]) <= 0.01 * len(rows)


def test_models_beyond_what_is_sent_to_workers(spark, scored, monkeypatch):
    """No word is dropped: a model that is too large to send out is joined."""
    docs, labels = corpus()
    docs = clashing(spark.createDataFrame(docs, SCHEMA), "score", "mean", "toxic", "word")
    monkeypatch.setattr(toxicity, "MODEL_WORDS", 1)
    out = toxicity.toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(scored[0])
    for r in out:
        assert r.score == pytest.approx(scored[0][r.doc_id].score) and r.predicted == scored[0][r.doc_id].predicted


def test_rarer_expressions_are_joined_in_rounds(spark, scored, monkeypatch):
    """No exchange holds what all rows ask for, and the scores stay."""
    docs, labels = corpus()
    monkeypatch.setattr(toxicity, "MODEL_WORDS", 1)
    monkeypatch.setattr(toxicity, "ROUND_ROWS", 200, raising=False)
    held, pinned = [], toxicity.pinned

    def spied(df, label):
        out = pinned(df, label)
        if label == "told":
            held.append(out.count())
        return out

    monkeypatch.setattr(toxicity, "pinned", spied)
    out = toxicity.toxicity(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    assert {r.doc_id: r.score for r in out} == pytest.approx({i: r.score for i, r in scored[0].items()})
    assert len(held) >= 4 and max(held) < 300 and sum(held[-3:]) == len(docs)


def test_pairs_of_frequent_words_are_dealt_out(spark):
    texts = [(words(30, i, 50), i % 2, i % 3 % 2) for i in range(40)]
    labelled = spark.createDataFrame(texts, "text string, toxic int, held int")
    frequent = toxicity.frequent_words(labelled)
    assert 0 < len(frequent) <= 1_000
    whole, dealt = toxicity.pair_counts(labelled), toxicity.pair_counts(labelled, frequent)
    assert sorted(whole.collect()) == sorted(dealt.collect())
    assert whole.select("word", "before").distinct().count() == whole.count()
    turns = [toxicity.pair_counts(labelled, frequent, turn, 2) for turn in (0, 1)]
    assert all(t.count() for t in turns)
    assert sorted(turns[0].collect() + turns[1].collect()) == sorted(whole.collect())


@pytest.mark.parametrize("sent", [10**6, 40])
def test_texts_are_scored_in_small_batches(spark, monkeypatch, sent):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows, pinned, before = {}, toxicity.pinned, spark.conf.get(key)

    def noted(df, label):
        rows.setdefault(label, []).append(int(spark.conf.get(key)))
        return pinned(df, label)

    monkeypatch.setattr(toxicity, "MODEL_WORDS", sent)
    monkeypatch.setattr(toxicity, "pinned", noted)
    docs, labels = corpus()
    out = toxicity.toxicity(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS))
    assert out.count() == len(docs) and spark.conf.get(key) == before
    found = rows.get("scored", []) + rows.get("told", [])
    assert len(found) == 2 and max(found) <= 2_000


def test_pairs_are_passed_on_in_small_batches(spark, monkeypatch):
    texts = [(words(400, i, 60), i % 2, 0) for i in range(40)]
    labelled = spark.createDataFrame(texts, "text string, toxic int, held int")
    want = sorted(map(tuple, toxicity.pair_counts(labelled).collect()))
    sizes, sliced = spark.sparkContext.accumulator(0), toxicity.sliced
    monkeypatch.setattr(toxicity, "PASSED_PAIRS", 7)

    def noted(columns, names):
        for batch in sliced(columns, names):
            sizes.add(batch.num_rows > 7)
            yield batch

    monkeypatch.setattr(toxicity, "sliced", noted)
    assert sorted(map(tuple, toxicity.pair_counts(labelled).collect())) == want and sizes.value == 0
    columns = [toxicity.pa.array(range(20))]
    batches = list(sliced(columns, ["n"]))
    assert [b.num_rows for b in batches] == [7, 7, 6]
    assert [n for b in batches for n in b.column(0).to_pylist()] == list(range(20))
