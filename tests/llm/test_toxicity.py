import zlib
from collections import Counter

import pytest

from gridpulse.llm import toxicity as op
from odd_cases import ODD


def held_out(d):
    return zlib.crc32(b"" if d is None else str(d).encode()) % 4 == 2


def vector(text, learnt=None):
    x = op.features(text, frozenset(op.INSULTS), learnt or {}, frozenset(op.SECOND_PERSON), {})
    return dict(zip(op.FEATURES, x, strict=True))


def test_features():
    x = vector("YOU are an idiot! A st0pid 1diot, really... you")
    assert x["lexicon_density"] == 2 / 9 and x["disguised_lexicon"] == 1 / 9 and x["person_density"] == 2 / 9
    assert x["near_person"] == 2 / 9 and x["shout_rate"] == 1 / 9 and x["disguised_rate"] == 2 / 9
    assert x["exclaim_rate"] == 1 / len("YOU are an idiot! A st0pid 1diot, really... you")
    assert vector("gruxel gruxeling", {"gruxel": 2.0, "gru*": 1.5})["learnt_weight"] == (2.0 + 1.5) / 2
    assert set(vector("").values()) == set(vector(" \n ").values()) == {0.0}


@pytest.fixture(scope="module")
def marked(spark):
    """Toxic texts share a made-up stem that no fixed list has, and clean ones never hold it."""
    rows = []
    for i in range(1200):
        text = " ".join(f"word{(i * 7 + j * 13) % 97} plain" for j in range(20))
        toxic = i % 5 == 0
        rows.append((i, text + (f" zorbik{'abcdef'[i % 6]} and zorbik{'ghijkl'[i % 6]}" if toxic else ""), int(toxic)))
    docs = spark.createDataFrame([(i, t, "x", 0.1) for i, t, _ in rows], "doc_id long, text string, score string, predicted double")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows if i % 2], "doc_id long, toxic int")
    return docs, labels, {i: x for i, _, x in rows}


def test_learns_from_training_labels_only(marked, spark):
    docs, labels, truth = marked
    rows = op.toxicity_scores(docs, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(truth.keys())
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    own = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in own) >= 0.97 * len(own)
    # Turning the labels of the held-out fold round changes nothing.
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 1 - toxic, toxic) AS toxic")
    again = {r.doc_id: r.score for r in op.toxicity_scores(docs, turned).collect()}
    assert {r.doc_id: r.score for r in rows} == pytest.approx(again)


def test_odd_rows_and_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (None, 1), (77, 1)], "doc_id long, toxic int")
    rows = op.toxicity_scores(odd_docs, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in ODD) and all(0 <= r.score <= 1 for r in rows)
    assert op.toxicity_scores(no_docs, labels).collect() == []
    assert len(op.toxicity_scores(odd_docs, labels.filter("false")).collect()) == len(ODD)
