from collections import Counter

import pytest

from gridpulse.llm import language as op
from odd_cases import ODD

WORDS = {
    "en": "the quick brown fox jumps over the lazy dog and runs through the old forest with his friends",
    "de": "der schnelle braune Fuchs springt über den faulen Hund und läuft durch den alten Wald",
    "fr": "le renard brun rapide saute par-dessus le chien paresseux et court à travers la forêt",
}


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, " ".join([t] * (1 + i % 3)), lang) for lang, t in WORDS.items() for i in range(100 * len(lang), 100 * len(lang) + 12)]
    rows = [(n, t, lang) for n, (_, t, lang) in enumerate(rows)]
    return spark.createDataFrame(rows + [(999, "x", None), (998, None, "en"), (997, "zz", "xx")], "doc_id long, text string, lang string")


def languages(df, key="key"):
    return {r[key]: r for r in df.collect()}


def test_text_alone(spark, labelled):
    rows = [(i, t, None, None, None) for i, t in enumerate([*WORDS.values(), "", None, "123 456 --- ...", "  "])]
    found = languages(op.identify(spark.createDataFrame(rows, "key long, text string, declared string, suffix string, host string"), labelled))
    assert [found[i].lang for i in range(7)] == ["en", "de", "fr", "und", "und", "und", "und"]


STRANGE = [
    "これは日本語の文章です。今日は天気がとても良いので、公園へ散歩に行きました。",
    "Быстрая коричневая лиса перепрыгивает через ленивую собаку и бежит через старый лес вместе с друзьями",
    "Nopea ruskea kettu hyppää laiskan koiran yli ja juoksee vanhan metsän läpi ystäviensä kanssa joka päivä",
    "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822cd15d6c15b0f00a08" * 3,
    "TWFuIGlzIGRpc3Rpbmd1aXNoZWQsIG5vdCBvbmx5IGJ5IGhpcyByZWFzb24sIGJ1dCBieSB0aGlzIHNpbmd1bGFy",
]


def test_other_languages_and_junk(spark, documents):
    """Texts of no modelled language are ``und``, whatever their host says, and their host learns nothing from them."""
    text = documents.filter("lang = 'de' AND n_chars > 500").orderBy("doc_id").first().text
    rows = [(i, t, "de", "at", "w1.haus.at") for i, t in enumerate(STRANGE)] + [(100 + i, t, None, None, "x.y") for i, t in enumerate(STRANGE * 20)]
    rows += [(1000, text, None, None, "x.y"), (1001, text[:250] + STRANGE[3][:40] + " 4111 1111 1111 1111", None, None, "x.y")]
    df = spark.createDataFrame(rows, "key long, text string, declared string, suffix string, host string")
    found = languages(op.identify(df, documents))
    assert {(r.lang, r.text_lang) for i, r in found.items() if i < 1000} == {("und", "und")}
    assert all(r.posterior < 0.5 for i, r in found.items() if i < 1000)
    assert found[1000].lang == found[1001].lang == "de" and found[1000].posterior > 0.99
    more = [(10**6 + i, t, None, "web", len(t)) for i, t in enumerate(STRANGE)]
    kept = op.with_known_language(documents.unionByName(spark.createDataFrame(more, documents.schema)))
    assert kept.count() == documents.count() and kept.filter("doc_id >= 1000000").count() == 0


def test_rare_languages_stay(spark):
    """A language of few labelled rows is modelled however many rows others have; those give about ``sample``."""
    rows = [(i, f"{WORDS['en']} {i}", "en") for i in range(3000)] + [(5000 + i, WORDS["fr"], "fr") for i in range(3)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert op.fit_text_model(labelled, 50)[0] == ["en", "fr"]
    asked = spark.createDataFrame([(1, WORDS["fr"], None, None, None)], "key long, text string, declared string, suffix string, host string")
    assert op.identify(asked, labelled, sample=50).first().lang == "fr"


def test_other_evidence_decides_short_texts(spark, labelled):
    """Hosts and declarations that go with a language tip the balance where the text says little."""
    rows = [(i, WORDS["de"] * 3, "de-AT", "at", f"w{i % 4}.haus.at") for i in range(60)]
    rows += [(100 + i, WORDS["en"] * 3, "en", "com", f"w{i % 4}.house.com") for i in range(60)]
    rows += [(1000, "an", "de", "at", "w1.haus.at"), (1001, "and", None, None, "w9.haus.at"), (1002, "und", "EN_us", "com", "w1.house.com")]
    df = spark.createDataFrame(rows, "key long, text string, declared string, suffix string, host string")
    found = languages(op.identify(df, labelled))
    assert found[1002].lang == "en" and found[1002].posterior > 0.5
    assert all(found[i].lang == "de" for i in range(60))
    alone = languages(op.identify(df.filter("key >= 1000").selectExpr("key", "text", "NULL declared", "NULL suffix", "NULL host").selectExpr(
        "key", "text", "CAST(declared AS string) declared", "CAST(suffix AS string) suffix", "CAST(host AS string) host"), labelled))
    assert alone[1002].text_lang == found[1002].text_lang


def test_pages_agree_with_their_markup(spark, sf_dir, documents):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    declared = {r.page_id: r.html.split('lang="')[1][:2] for r in pages.collect()}
    found = languages(op.page_languages(pages, documents), "page_id")
    assert {i: r.lang for i, r in found.items()} == declared
    assert sum(r.text_lang == declared[i] for i, r in found.items()) >= 0.95 * len(declared)


def test_odd_pages(spark, labelled):
    rows = [(1, None, None), (2, "", ""), (3, "not an address", "<html lang=><p>" + WORDS["fr"]), (3, "not an address", "<html lang=><p>" + WORDS["fr"]),
            (None, "http://a.b/", "<script>" + WORDS["de"]), (5, "http://u@h.org:80/x", "<!-- " + WORDS["de"] + "--><p>" + WORDS["en"])]
    found = Counter((r.page_id, r.lang) for r in op.page_languages(spark.createDataFrame(rows, "page_id long, url string, html string"), labelled).collect())
    assert found[3, "fr"] == 2 and found[1, "und"] == found[2, "und"] == 1 and found[5, "en"] == 1 and sum(found.values()) == 6


def test_stage(odd_docs, documents, no_docs):
    kept = op.with_known_language(documents)
    assert kept.count() == documents.count() and kept.columns == documents.columns
    out = op.with_known_language(odd_docs)
    assert out.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in out.collect())
    assert ids[1] == ids[2] == ids[3] == 0 and ids[4] == sum(d == 4 for d, _ in ODD)
    assert op.with_known_language(no_docs).collect() == []


def test_nothing_labelled(spark, labelled):
    rows = spark.createDataFrame([(1, WORDS["en"], None, None, None)], "key long, text string, declared string, suffix string, host string")
    assert op.identify(rows, labelled.filter("false")).first().lang == "und"
