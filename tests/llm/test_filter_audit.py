import re
from collections import Counter
from itertools import permutations

import pytest

from gridpulse.llm import filter_audit as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute_force(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    parts = {}
    for i, t, lang in rows:
        t = t or ""
        words = WORD.findall(t)
        failed = set()
        failed |= {"A"} if len(words) < 200 else set()
        failed |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        failed |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else set()
        failed |= {"D"} if re.search("[#$%&*|]", t) else set()
        failed |= {"E"} if i is not None and first[t] < i else set()
        parts.setdefault(lang or "", []).append((frozenset(failed), i in good, i in toxic))
    out = {}
    for part, docs in parts.items():
        removed_in_all = Counter()
        for order in permutations("ABCDE"):
            rest = docs
            for step, f in enumerate(order, 1):
                hit = [d for d in rest if f in d[0]]
                rest = [d for d in rest if f not in d[0]]
                removed_in_all[f] += len(hit)
                fails = sum(f in d[0] for d in docs)
                out[part, "".join(order), step] = [
                    len(rest), len(hit), fails - len(hit), sum(d[0] == {f} for d in docs), sum(d[1] for d in hit), sum(d[2] for d in hit)
                ]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(removed_in_all[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def run(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, lang string, part string, n int, bits int")
    judged = spark.createDataFrame([(*r, "y") for r in labels], "doc_id long, quality int, toxic int, lang string")
    return op.filter_audit(docs.repartition(4), judged)


def found(spark, rows, labels):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in run(spark, rows, labels).collect()}


def prose(n, seed=0):
    return " ".join(f"w{(i * 7919 + seed) % 100_003}" for i in range(n))


ROWS = [
    (1, None, "en"), (2, "", None), (3, " \n", ""), (4, prose(300), "en"), (5, prose(300), "de"), (-5, prose(250, 1), "en"),
    (6, prose(250, 1), "en"), (6, prose(250, 1), "en"), (6, prose(260, 2), "en"), (7, "WORD " * 400, "en"), (8, "a b & c", "fr"),
    (9, prose(200, 3) + " #", "fr"), (10, prose(199, 4), "fr"), (11, "Word " * 200, "it"), (None, prose(300), "en"), (None, None, None),
    (12, "ABC", "en"), (13, "abc\x00", "en"), (14, "é" * 100 + "AAAA", "en"), (15, "x" * 5_000_000, "en"), (16, "x " * 400_000 + "X", "en"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (4, 1, 1), (5, 1, None), (6, None, 1), (6, 1, 0), (None, 1, 1), (99, 1, 1), (9, 1, 0)]


def test_odd_rows(spark):
    rows = ROWS + [(100 + i, prose(300), "en") for i in range(60)]
    assert found(spark, rows, LABELS) == brute_force(rows, LABELS)


def test_spread_texts(spark, monkeypatch):
    """Texts held by many documents meet in many places."""
    monkeypatch.setattr(op, "SPREAD", 20)
    monkeypatch.setattr(op, "SLOTS", 4)  # texts of other slots' hashes come along and change nothing
    rows = [(i, prose(210, i % 3 if i % 2 else i), "en") for i in range(400)] + [(1000 + i, "", "de") for i in range(150)]
    assert found(spark, rows, LABELS) == brute_force(rows, LABELS)


def test_equal_hashes_of_other_texts(spark, monkeypatch):
    """Texts are compared, not only their hashes."""
    rows = [(1, prose(210), "en"), (2, prose(211), "en"), (3, prose(210), "en"), (4, prose(211), "en"), (5, prose(212), "en")]
    from pyspark.sql import functions as F

    def one_hash(docs, *others):
        t = F.coalesce(F.col("text"), F.lit(""))
        return docs.select(F.col("doc_id").alias("d"), F.length(t).cast("long").alias("rid"), t.alias("t"), *others)

    monkeypatch.setattr(op, "texts", one_hash)
    assert found(spark, rows, LABELS) == brute_force(rows, LABELS)


@pytest.mark.parametrize("labels", [[], LABELS])
def test_no_labels_and_no_rows(spark, labels):
    assert found(spark, ROWS[:4], labels) == brute_force(ROWS[:4], labels)
    assert run(spark, ROWS, labels).schema == run(spark, ROWS[:1], labels).schema
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert op.filter_audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect() == []
