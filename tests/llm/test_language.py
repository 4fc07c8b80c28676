import pytest
from pyspark.sql import functions as F

from tallywatch.llm import language, queries
from tests.llm.edges import SCHEMA, clashing, edge_docs, edge_rows, empty_docs

TEXTS = {
    "en": "the quick brown foxes are jumping over the lazy dogs while singing something nothing",
    "de": "der schnelle braune Fuchs springt über den faulen Hund während die Zeitung gelesen wird",
    "fr": "le renard brun saute par dessus le chien paresseux pendant que les enfants mangeaient",
}
PAGES = "page_id long, url string, html string"


def html(lang, text):
    return f'<html lang="{lang}-XX"><script>var the = "nothing";</script><p>{text}</p></html>'


@pytest.fixture(scope="module")
def found(spark):
    docs = [(i, f"{TEXTS[x]} {i}", x, f"src-{x}", 0) for i, x in enumerate(list(TEXTS) * 20)]
    docs.append((900, TEXTS["fr"], None, "src-fr", 0))  # no declaration
    docs.append((901, None, None, "src-de", 0))  # no text: the host tells
    docs.append((902, TEXTS["en"], "de", None, 0))  # a wrong declaration
    docs.append((903, "", None, None, None))
    pages = [(i, f"https://www.site.example/{x}/{i}", html(x, TEXTS[x])) for i, x in enumerate(list(TEXTS) * 20)]
    pages += [
        (500, "https://www.site.example/fr/x", html("fr", "xyz")),
        (501, "not an address", "<p>" + TEXTS["de"]),
        (502, None, None),
        (503, "http://u:p@Other.Example.DE:80/", html("de", "")),
    ]
    df = clashing(spark.createDataFrame(docs, SCHEMA), "host", "post", "declared", "is_page")
    rows = language.identify(df, clashing(spark.createDataFrame(pages, PAGES), "text", "lang")).collect()
    assert len(rows) == len(docs) + len(pages)
    return {("d", r.doc_id) if r.page_id is None else ("p", r.page_id): r for r in rows}


def test_texts_are_told_apart(found):
    for i, lang in enumerate(list(TEXTS) * 20):
        assert found["d", i].lang == found["p", i].lang == found["p", i].text_lang == lang


def test_each_evidence_counts(found):
    assert found["d", 900].lang == "fr"
    assert found["d", 901].lang == "de"  # by its host
    assert found["d", 902].lang == "en"  # text against declaration
    assert found["p", 500].lang == "fr"  # by declaration and address
    assert found["p", 501].lang == "de"
    assert found["p", 503].host == "other.example.de" and found["p", 503].declared == "de"
    assert all(0 < r.probability <= 1 for r in found.values())


def test_edges(spark):
    none = spark.createDataFrame([], PAGES)
    out = language.identify(edge_docs(spark), none).collect()
    assert len(out) == len(edge_rows()) and all(r.lang == "en" for r in out)
    assert language.identify(empty_docs(spark), none).count() == 0
    nobody = edge_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    rows = language.identify(nobody, none).collect()
    assert len(rows) == len(edge_rows()) and {(r.lang, r.probability) for r in rows} == {(None, 0.0)}


def test_held_out_languages(spark):
    """Every fifth document's language is hidden and found again."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    real = {r.doc_id: r.lang for r in docs.collect()}
    hidden = docs.selectExpr("doc_id", "text", "if(doc_id % 5 = 0, null, lang) as lang", "source")
    none = spark.createDataFrame([], PAGES)
    rows = [r for r in language.identify(hidden, none).collect() if r.doc_id % 5 == 0]
    assert sum(r.lang == real[r.doc_id] for r in rows) >= 0.97 * len(rows)


def test_query(spark):
    rows = queries.op6_language(spark, "/root/testdata/sf0.001").collect()
    assert sum(r.page_id is None for r in rows) == 200 and len(rows) > 200


def test_models_beyond_what_is_sent_to_workers(spark, monkeypatch):
    """No affix is dropped: a model that is too large to send out is joined."""
    texts = ["the house and the garden", "das Haus und der Garten", "", None, "and garden", "und xyzzy"]
    docs = spark.createDataFrame(
        [(i, t, ["en", "de"][i % 2], "a", 0) for i, t in enumerate(texts)],
        "doc_id long, text string, lang string, source string, n_chars int",
    )
    rows = docs.select("doc_id", "text", language.F.lit(False).alias("is_page"))

    def found():
        model = language.text_model(docs)
        out = language.likelihoods(rows, model, ["doc_id"]).collect()
        return isinstance(model[1], dict), {r.doc_id: r.loglik for r in out}

    small, want = found()
    monkeypatch.setattr(language, "AFFIXES", 3)
    large, got = found()
    assert small and not large and len(got) == len(texts)
    assert all(got[i] == pytest.approx(want[i]) for i in want)


def test_declared_after_a_long_comment(spark):
    pages = ["<!-- <html lang=fr> " + "x " * 5000 + "--><html class=a lang=de>", "y " * 9000 + "<html lang='en-GB'>", None, "<p>"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    out = df.select("i", language.declared(language.F.col("html")).alias("d")).collect()
    assert [r.d for r in sorted(out)] == ["de", "en", None, None]
