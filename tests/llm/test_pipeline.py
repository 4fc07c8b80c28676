"""The pipeline's stages, each against what it should have done to its input."""

import re

import pytest

import corpus_pipeline
from tallywatch.llm import queries, toxicity
from tallywatch.llm.common import table
from tests.llm.edges import SCHEMA
from tests.llm.test_ngram_join import brute_force
from tests.llm.test_toxicity import LABELS, corpus

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Each stage's input and output, written and read again."""
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        result = spark.read.parquet(path)
        out[name] = (docs, result)
        docs = result
    return out


def test_stages_are_named_and_keep_the_columns(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "pii", "mixing", "packing"]
    for name in list(kept)[:-1]:
        before, after = kept[name]
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert after.dtypes == before.dtypes


def test_toxic_documents_go_and_clean_ones_stay(spark, kept):
    before, after = kept["toxicity"]
    gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    toxic = {r.doc_id for r in table(spark, SF, "labels").filter("toxic = 1").collect()}
    clean = {r.doc_id for r in table(spark, SF, "labels").filter("toxic = 0").collect()}
    # at this size 14 of the 51 have no word that two other toxic documents have
    assert len(gone & toxic) >= 0.7 * len(toxic) and len(gone & clean) <= 0.01 * len(clean)


@pytest.mark.parametrize("sent", [10**6, 40])
def test_texts_do_not_come_back_from_scoring(spark, monkeypatch, tmp_path, sent):
    """Equal rows, null texts and ids among them; the rows that stay are those with a low score."""
    asked, score = [], toxicity.score

    def noted(docs, model, keep):
        asked.append(keep)
        return score(docs, model, keep)

    monkeypatch.setattr(toxicity, "MODEL_WORDS", sent)
    rows, marks = corpus(300)
    rows += rows[:9] + [(None, rows[0][1], "en", "a", 1), (None, None, None, None, None), (7, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(marks, LABELS)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    scored = toxicity.score(docs, toxicity.train(docs, labels), docs.columns)
    want = sorted(map(repr, scored.filter("score < 0.5").select(*docs.columns).collect()))
    monkeypatch.setattr(toxicity, "score", noted)
    found = corpus_pipeline.without_toxic(spark, docs, str(tmp_path))
    assert sorted(map(repr, found.collect())) == want
    assert 200 < len(want) < len(rows) and asked == [["__row"]] and found.columns == docs.columns


def test_one_of_each_group(kept):
    before, after = kept["ngram_join"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = brute_force(rows, corpus_pipeline.NGRAM, corpus_pipeline.SIMILAR)
    assert {r.doc_id for r in after.collect()} == {w[2] for w in want}
    assert after.count() < before.count()


def test_personal_data_is_gone(kept):
    before, after = kept["pii"]
    assert before.count() == after.count()
    text = {r.doc_id: r.text for r in before.collect()}
    found = re.compile(r"\b[a-z]+\.\d+@mail\d\.example\.com|\b\d{16}\b|\+1 \(\d{3}\) 555-\d{4}")
    changed = 0
    for r in after.collect():
        assert r.n_chars == len(r.text)
        private = found.findall(text[r.doc_id])
        changed += bool(private)
        assert not [p for p in private if p in r.text]
        assert private or r.text == text[r.doc_id] or "=" in text[r.doc_id] or re.search(r"\d", text[r.doc_id])
    assert changed > 20


def test_mix_and_sequences(kept):
    before, after = kept["mixing"]
    size = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in before.collect())
    mixed = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in after.collect())
    assert abs(mixed - 1.5 * size) <= 0.02 * size
    pieces = kept["packing"][1].collect()
    assert len({r.doc_id for r in pieces}) == after.select("doc_id").distinct().count()
    fill = sum(r.length for r in pieces) / (1024 * len({r.sequence_id for r in pieces}))
    assert fill > 0.97


def test_run_is_the_stages_one_after_the_other(spark, kept):
    rows = corpus_pipeline.run(spark, SF)
    want = kept["packing"][1]
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows.select(keys).exceptAll(want.select(keys)).isEmpty()
    assert rows.count() == want.count()


def test_registered_queries():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and corpus_pipeline.ORACLE_SQL is None
    assert set(queries.QUERIES) == set(names)
