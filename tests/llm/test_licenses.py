"""Licence scans against a plain reading of every block and place."""

import random
import re
from fractions import Fraction

import pytest

from tallywatch.llm import licenses
from tallywatch.llm.queries import QUERIES
from tests.llm.edges import clashing, edge_docs, empty_docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, templates=licenses.TEMPLATES, base=licenses.BASE, contained=licenses.CONTAINED):
    """Every place and every block, one after the other."""
    w = plain_words(text)
    places = []
    for phrase, label in base:
        p = phrase.split()
        places += [(label, i) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    blocks = []
    for label, template in templates:
        t = plain_words(template)
        width = 4
        while width < len(t):
            width *= 2
        for start in range(0, len(w), width):
            shared = len(set(t) & set(w[start : start + 2 * width]))
            if Fraction(shared, len(set(t))) >= contained:
                blocks.append((label, start, min(len(w), start + 2 * width) - 1, shared / len(set(t))))
    return len(w), sorted(places), sorted(blocks)


def shown(row):
    return (
        row["n_words"],
        sorted((p["label"], p["word"]) for p in row["places"]),
        sorted((b["label"], b["first"], b["last"], b["containment"]) for b in row["blocks"]),
    )


def test_no_block_is_lost(spark):
    rng = random.Random(5)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in plain_words(t)})
    docs = []
    for i in range(250):
        parts = []
        for _ in range(rng.randrange(6)):
            parts += rng.choices(vocabulary + ["other", "thing", "été"], k=rng.randrange(30))
            notice = plain_words(rng.choice(licenses.TEMPLATES)[1])
            for _ in range(rng.randrange(3)):  # damaged a little
                notice[rng.randrange(len(notice))] = rng.choice(vocabulary)
            parts += notice
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts)))
    docs += [(900 + i, f"x {text}. y") for i, (_, text) in enumerate(licenses.TEMPLATES)]
    docs += [(990, "cc by cc by-cc BY general public license All Rights Reserved"), (991, "all rights")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: shown(r) for r in licenses.scan(df).collect()}
    assert found == {i: brute(text) for i, text in docs}
    assert all(found[900 + i][2] for i in range(len(licenses.TEMPLATES)))


@pytest.mark.parametrize("contained", [Fraction(1, 2), Fraction(2, 3), Fraction(1)])
def test_other_thresholds(spark, contained):
    rng = random.Random(9)
    templates = [(f"t{i}", " ".join(rng.choices("abcdefghijkl", k=rng.randrange(1, 12)))) for i in range(20)]
    docs = [(i, " ".join(rng.choices("abcdefghijklmnopq", k=rng.randrange(60)))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {
        r["doc_id"]: shown(r)
        for r in licenses.scan(df, templates=templates, base=(), contained=contained).collect()
    }
    assert found == {i: brute(text, templates, (), contained) for i, text in docs}


def test_long_texts_are_read_in_slices(monkeypatch):
    monkeypatch.setattr(licenses, "SLICE", 50)
    text = "é".join(f" word{i}, all rights RESERVED " for i in range(200))
    assert licenses.all_words(text) == [w.encode() for w in plain_words(text)]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    out = QUERIES["op13_licenses"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(out) == len(texts)
    for r in out:
        n, places, blocks = brute(texts[r["doc_id"]])
        starts = [p for _, p in places]
        assert (r["n_words"], r["n_base"]) == (n, len(places))
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({b for b, _ in places}))
        assert r["labels"] == ",".join(sorted({b for b, *_ in [*places, *blocks]}))
        assert r["score"] == (1.0 if places else max((b[3] for b in blocks), default=0.0))


def test_planted_notices_get_labels_of_the_method(spark):
    lines = {
        "Released under the MIT License.": "mit",
        "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc",
        "Licensed under the Apache License, Version 2.0.": "apache",
        "This work is licensed under the GNU General Public License, version 3.": "gnu-gpl,gpl",
        "Released under the new license of the house, all others mit.": "",
        "The rights of all are reserved.": "",
    }
    df = spark.createDataFrame([(i, f"Some text.\n{t}") for i, t in enumerate(lines)], "doc_id long, text string")
    out = licenses.summarised(licenses.scan(df)).orderBy("doc_id").collect()
    assert [r["labels"] for r in out[:4]] == list(lines.values())[:4]
    assert out[5]["labels"] == ""


def test_edges(spark):
    docs = clashing(edge_docs(spark), "n_words", "places", "label")
    out = licenses.summarised(licenses.scan(docs)).collect()
    assert len(out) == docs.count()
    null = [r for r in out if r["n_words"] == 0]
    assert null and all((r["n_base"], r["first_word"], r["labels"], r["score"]) == (0, None, "", 0.0) for r in null)
    assert licenses.summarised(licenses.scan(empty_docs(spark))).count() == 0


def test_too_many_templates(spark, monkeypatch):
    monkeypatch.setattr(licenses, "TEMPLATE_WORDS", 10)
    with pytest.raises(ValueError, match="templates"):
        licenses.scan(empty_docs(spark))
