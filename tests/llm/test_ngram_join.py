import random
from fractions import Fraction

import numpy as np
import pytest

from tallywatch.llm import components, ngram_join
from tests.llm.edges import SCHEMA, clashing, edge_docs, edge_rows, empty_docs, words


def shingles(text, n):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) or frozenset([tuple(w)])


def brute_force(rows, n, similar):
    sets = [shingles(r[1], n) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            both = len(a & b)
            if a and b and both >= similar * (len(a) + len(b) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(r[0], least.get(root(i), r[0]))
    return sorted(
        ((r[0], len(sets[i]), least.get(root(i))) for i, r in enumerate(rows)), key=str
    )


def got(df, n=4, similar=Fraction(85, 100)):
    rows = ngram_join.similar_groups(df, n, similar).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def edited(text, changes, rng):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
    return " ".join(w)


def corpus():
    """Copies at every distance around the limit, short texts, chains and a large group."""
    rng, rows, doc_id = random.Random(5), [], 1000
    for size in (5, 7, 9, 12, 20, 40, 90, 200):
        for k in range(6):
            base = words(size, size * 10 + k, 10_000)
            for changes in (0, 0, 1, 1, 2, 3, size // 40, size // 30):
                doc_id -= 1
                rows.append((doc_id, edited(base, changes, rng), "en", "a", 0))
    chain = words(120, 77, 10_000)
    for _ in range(12):
        chain = edited(chain, 1, rng)
        doc_id -= 1
        rows.append((doc_id, chain, "en", "a", 0))
    base = words(100, 99, 10_000)
    for _ in range(60):
        doc_id -= 1
        rows.append((doc_id, edited(base, rng.randrange(5), rng), "en", "a", 0))
    return rows


@pytest.mark.parametrize("n,similar", [(4, Fraction(85, 100)), (5, Fraction(4, 5))])
def test_components_are_those_of_all_pairs(spark, n, similar):
    rows = corpus()
    want = brute_force(rows, n, similar)
    assert len({w[2] for w in want}) < len(rows) - 100
    assert got(spark.createDataFrame(rows, SCHEMA), n, similar) == want


def test_edges(spark):
    df = clashing(edge_docs(spark), "cls", "row", "key", "n_shingles", "component_id")
    rows = [r for r in edge_rows()]
    assert got(df) == brute_force(rows, 4, Fraction(85, 100))
    assert got(empty_docs(spark)) == []


def test_the_limit_itself_links():
    """37 of 40 shingles shared of 43 in all is above, 34 of 40 is the limit."""
    assert ngram_join.apart(74) == 6
    assert 100 * 34 >= 85 * 40 and not 100 * 33 >= 85 * 40


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a = np.unique(rng.integers(0, 1 << 63, 200).astype(np.uint64))
        b = np.unique(np.concatenate([a[20:], rng.integers(0, 1 << 63, 15).astype(np.uint64)]))
        apart = len(np.setxor1d(a, b))
        x, y = ngram_join.whole_sketch(a), ngram_join.whole_sketch(b)
        assert ngram_join.sketch_distance(x, y) <= apart
        big = ngram_join.whole_sketch(np.concatenate([a, rng.integers(0, 1 << 63, 400).astype(np.uint64)]))
        assert ngram_join.sketch_distance(x, big) <= 400


def test_every_pair_within_reach_shares_a_bucket():
    """Equal segment, followed by one that differs in one bit at most."""
    rng = np.random.default_rng(3)
    tops = ngram_join.bands()
    for size in (7, 8, 20, 60, 300):
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            away = ngram_join.apart(2 * len(a)) // 2
            b = np.unique(np.concatenate([a[away:], rng.integers(0, 1 << 63, away).astype(np.uint64)]))
            band = int(np.searchsorted(tops, max(len(a), len(b))))
            x, y = (np.frombuffer(ngram_join.segments(s, band), "<u4") for s in (a, b))
            near = np.bitwise_count(np.roll(x ^ y, -1)) <= 1
            assert (near & (x == y)).any()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, -3)]
    df = spark.createDataFrame(links, "u long, v long")
    roots = dict(components.components(df).collect())
    assert {roots[i] for i in range(41)} == {-3} and roots[-3] == -3
    assert {roots[i] for i in range(100, 130)} == {100}


def test_one_of_each_group(spark):
    rows = corpus()
    n, similar = 5, Fraction(4, 5)
    df = spark.createDataFrame([*rows, *rows[:3], *edge_rows()], SCHEMA)
    kept = ngram_join.without_duplicates(df, n, similar).collect()
    want = brute_force([*rows, *rows[:3], *edge_rows()], n, similar)
    groups = {w[2] for w in want if w[1] > 0 and w[2] is not None}
    ids = [r.doc_id for r in kept if shingles(r.text, n) and r.doc_id is not None]
    assert sorted(ids) == sorted(groups)
    assert sum(not shingles(r.text, n) for r in kept) == 4  # nothing links with those
    assert len([r for r in kept if r.doc_id is None and r.text]) == 1


def test_pairs_of_buckets_that_are_small_at_last_are_tried(spark, monkeypatch):
    """All buckets are split three times here, and few members of each are left together."""
    shared = ngram_join.shared_buckets

    def by_level(rows, parts, level):
        monkeypatch.setattr(ngram_join, "FEW", 1 if level < ngram_join.LEVELS else 16)
        return shared(rows, parts, level)

    monkeypatch.setattr(ngram_join, "shared_buckets", by_level)
    rows = corpus()
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute_force(rows, 4, Fraction(85, 100))


def test_large_tables_are_dealt_in_rounds(spark, monkeypatch):
    """No exchange holds the rows of all segments, and components stay those of all pairs."""
    exchanges, emitted = [], ngram_join.bucket_rows

    def spied(*args):
        exchanges.append(emitted(*args))
        return exchanges[-1]

    monkeypatch.setattr(ngram_join, "bucket_rows", spied)
    monkeypatch.setattr(ngram_join, "ROUND_ROWS", 500, raising=False)
    rows = corpus()
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute_force(rows, 4, Fraction(85, 100))
    held = [e.count() for e in exchanges]
    assert max(held) < sum(held) / 2


def test_buckets_left_to_compare_hold_a_set_of_their_band(spark, monkeypatch):
    """Sets that also stand in the next band's buckets are compared in those of their own."""
    rng, top = random.Random(7), int(ngram_join.bands()[np.searchsorted(ngram_join.bands(), 100)])
    base = words(top + 3, 1, 10_000)  # the largest sets of a band: all of them look upwards
    rows = [(i, edited(base, 2 + i % 9, rng), "en", "a", 0) for i in range(150)]
    held, pinned = {}, ngram_join.pinned

    def spied(df, label):
        held.setdefault(label, []).append(out := pinned(df, label))
        return out

    monkeypatch.setattr(ngram_join, "pinned", spied)
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute_force(rows, 4, Fraction(85, 100))
    band = {r.cls: r.band for r in held["sets"][0].collect()}
    buckets = {}
    for r in held["mixed-buckets"][0].collect():
        buckets.setdefault(r.key, set()).add(band[r.cls] == r.base >> ngram_join.BAND_AT)
    assert not held["smaller-buckets"][1].filter("kind = 1").isEmpty()
    assert all(True in own for own in buckets.values())


def test_texts_go_to_workers_in_small_batches(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    sent, pinned, before = {}, ngram_join.pinned, spark.conf.get(key)

    def noted(df, label):
        sent.setdefault(label, []).append(int(spark.conf.get(key)))
        return pinned(df, label)

    monkeypatch.setattr(ngram_join, "pinned", noted)
    rows = corpus()
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute_force(rows, 4, Fraction(85, 100))
    assert max(sent["sets"]) <= 2_000 and max(sent["links"]) <= 1_000
    assert sent["buckets"] == [int(before)] and spark.conf.get(key) == before
