import re

import pytest

from tallywatch.llm import mixing, queries
from tallywatch.llm.common import content, n_words, numbered
from tests.llm.edges import SCHEMA, edge_docs, edge_rows, empty_docs, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Shares by weight, the excess over the caps shared again, step by step."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, out = share * sum(sizes.values()), {}
    free = list(order)
    while free:
        level = left / sum(weight[s] for s in free)
        above = [s for s in free if level * weight[s] > most * sizes[s]]
        if not above:
            return out | {s: level * weight[s] for s in free}
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def mixed(spark, df):
    held = content(df, "doc_id", "text").alias("content")
    rows = df.select("doc_id", "source", n_words("text").alias("size"), held)
    return mixing.taken(numbered(rows, "row", "sizes")).collect()


def check(rows):
    sizes, taken = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.taken <= 2 * r.size
    want = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
    for s, target in want.items():
        assert abs(taken[s] - target) <= 4 * mixing.BLOCK_WORDS


def test_targets_and_taken(spark):
    rows = [
        (i, words(20 + i % 300, i), "en", f"s{i * i % 7}" if i % 3 else "hot", 0)
        for i in range(400)
    ]
    out = mixed(spark, spark.createDataFrame(rows, SCHEMA))
    check(out)
    again = mixed(spark, spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.doc_id, r.taken) for r in out) == sorted((r.doc_id, r.taken) for r in again)


def test_edges(spark):
    out = mixed(spark, edge_docs(spark))
    assert len(out) == len(edge_rows())
    check(out)
    sizes = {(r.doc_id, r.size) for r in out}
    assert all((i, len(WORD.findall(t or ""))) in sizes for i, t, *_ in edge_rows())


def test_empty_and_wordless(spark):
    assert mixed(spark, empty_docs(spark)) == []
    out = mixed(spark, spark.createDataFrame([(1, "", "en", "a", 0)], SCHEMA))
    assert [(r.target, r.taken) for r in out] == [(0.0, 0)]


def test_slots_hold_sources_in_their_shares(spark):
    rows = [(i, words(50, i), "en", "abc"[i % 3], 0) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.select("source", n_words("text").alias("size"), content(df).alias("content"))
    sized, _, mix = mixing.mix(numbered(df, "row", "sizes"), block_words=10)
    got = mix.join(sized.select("row", "source"), "row").select("slot", "source").distinct().collect()
    n = max(r.slot for r in got) + 1
    for low in range(0, n - 200, 200):  # any stretch of the mix, not only the whole
        part = [r.source for r in got if low <= r.slot < low + 200]
        assert abs(part.count("a") / len(part) - 3 / 6 / 1) < 0.2
        assert part.count("b") < part.count("c") < part.count("a") * 1.1


def test_documents_of_the_mix(spark):
    rows = [(i, words(30, i), "en", "ab"[i % 2], 1) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mixed_documents(df, n_words("text")).collect()
    text = {r[0]: r[1] for r in rows}
    cut = [r for r in out if r.text != text[r.doc_id]]
    assert len(cut) <= 2 and all(text[r.doc_id].startswith(r.text) for r in cut)
    assert abs(sum(len(r.text.split()) for r in out) - 1.5 * 1200) <= 4 * mixing.BLOCK_WORDS


def test_query(spark):
    rows = queries.op3_mixing(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r.taken <= 2 * r.size for r in rows)


def test_short_sources_get_their_words(spark):
    rows = [(i, words(400, i), "en", f"s{i % 20:02}", 0) for i in range(200)]
    rows += [(1000 + i, words(10 + i % 40, i), "en", f"t{i:02}", 0) for i in range(60)]
    out = mixed(spark, spark.createDataFrame(rows, SCHEMA))
    taken, target = {}, {}
    for r in out:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert {s: n for s, n in taken.items() if abs(n - target[s]) > 0.5} == {}


def test_a_cut_keeps_white_space(spark):
    rows = [(i, "\n".join(words(30 + i, i).split()), "en", "ab"[i % 2], 1) for i in range(40)]
    out = mixing.mixed_documents(spark.createDataFrame(rows, SCHEMA), n_words("text")).collect()
    text = {r[0]: r[1] for r in rows}
    assert all(text[r.doc_id].startswith(r.text) for r in out)
    assert any(r.text != text[r.doc_id] for r in out)


def test_the_mix_does_not_depend_on_files_or_splits(spark, tmp_path):
    rows = [(i, words(20 + i % 70, i), "en", f"s{i % 7}", 0) for i in range(400)]
    rows += [rows[3]] * 90 + [(None, None, None, None, None), (None, "a few words", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    found, documents = [], []
    for parts in (1, 3, 8):
        path = str(tmp_path / f"in{parts}")
        df.repartition(parts).write.parquet(path)
        read = spark.read.parquet(path)
        found.append(sorted((str(r.doc_id), r.size, r.taken) for r in mixed(spark, read)))
        out = mixing.mixed_documents(read, n_words("text"))
        documents.append([tuple(r) for r in out.collect()])
    assert found[0] == found[1] == found[2]
    assert documents[0] == documents[1] == documents[2]  # in the same order, too


def test_documents_come_in_the_order_of_the_mix(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "STRETCH", 50)
    rows = [(i, words(64, i), "en", "abc"[i % 3], 0) for i in range(600)]
    mixing.mixed_documents(spark.createDataFrame(rows, SCHEMA), n_words("text")).write.parquet(f"{tmp_path}/mix")
    files = sorted((tmp_path / "mix").glob("part-*.parquet"))
    assert len(files) > 5
    got = [r.source for f in files for r in spark.read.parquet(str(f)).select("source").collect()]
    share = {s: got.count(s) / len(got) for s in "abc"}
    for low in range(0, len(got) - 150, 150):
        part = got[low : low + 150]
        assert all(abs(part.count(s) / 150 - share[s]) < 0.12 for s in "abc")
