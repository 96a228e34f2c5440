import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from odd_cases import ODD
from gridpulse.llm import line_dedup as op

STRIP = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(STRIP))


def brute_force(rows):
    rank = lambda d: (d is None, d or 0)
    first, holders = {}, {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            holders.setdefault(k, set()).add(d)
            first[k] = min(first.get(k, d), d, key=rank)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        gone = lambda line: len(k := key(line)) >= 10 and len(holders[k]) > 1 and first[k] != d  # noqa: E731, B023
        kept = "\n".join(x for x in lines if not gone(x))
        out.append((d, len(lines), sum(map(gone, lines)), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def found(df):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in op.line_dedup(df).collect())


def test_odd_cases(odd_docs):
    assert found(odd_docs) == Counter(brute_force(ODD))


def test_documents(documents, texts_of):
    assert found(documents) == Counter(brute_force(list(texts_of.items())))


def test_empty(no_docs):
    assert op.line_dedup(no_docs).collect() == []


def test_hot_line(make_docs, monkeypatch):
    rows = [(i, f"a line that everybody repeats\nown line number {i}" * (1 + i % 2)) for i in range(3000)]
    hot = []
    original = op._hot_hashes
    monkeypatch.setattr(op, "_hot_hashes", lambda lines: hot.append(original(lines)) or hot[-1])
    assert found(make_docs(rows)) == Counter(brute_force(rows))
    assert hot[0] is not None and hot[0].count() >= 1


def test_no_python_in_the_plan(documents):
    plan = op.line_dedup(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_stage_keeps_columns(odd_docs):
    out = op.without_repeated_lines(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    row = out.filter("doc_id = 5").first()
    assert row.text == "\nshort\nshort\n" and row.n_chars == len(row.text)
    assert out.filter("doc_id = 1").first().text is None


@pytest.mark.parametrize("line", ["\xa0exactly ten", "ÀÉÎÕÜ àéîõü", "İstanbul line"])
def test_only_ascii_is_folded(make_docs, line):
    rows = [(1, line), (2, line.lower()), (3, line + "\x0b")]
    assert found(make_docs(rows)) == Counter(brute_force(rows))


def test_bitmaps_are_by_line(make_docs):
    rows = [(1, "the first long line"), (2, "\n".join(["x"] * 130 + ["the first long line"]))]
    drops = op.drop_bitmaps(make_docs(rows)).select("n_dropped", F.col("drops")).collect()
    assert [(r.n_dropped, list(r.drops)) for r in drops] == [(1, [0, 0, 4])]
