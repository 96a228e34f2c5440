from collections import Counter

import pytest

from gridpulse.llm import licenses as op
from odd_cases import ODD

LINES = {
    "apache": "Licensed under the Apache License, Version 2.0.",
    "gpl": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "released under the mit license",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "reserved": "All rights reserved.",
}


@pytest.fixture(scope="module")
def scanned(spark, documents):
    """The documents, and own ones with licence lines in front, behind, in other words and in long paragraphs."""
    filler = "Thonthsh ouinst from erble at antible haorea are the it hean"
    rows = [(10_000 + i, f"{filler}\n{line}\n{filler}") for i, line in enumerate(LINES.values())]
    rows += [
        (10_100, f"{LINES['mit']}\n{LINES['gpl']}"),
        (10_101, " ".join([filler] * 20) + " " + LINES["apache"] + " " + " ".join([filler] * 20)),
        *((10_200 + i, " ".join([filler] * 20) + " " + line + " " + " ".join([filler] * (15 + i))) for i, line in enumerate(LINES.values())),
        (10_300, "rights reserved for us, all rights to it and the rights of all"),
        (10_301, " ".join("as conditions without License modified and compliance any use file under writing with may law except agreed".split())),
        (10_102, "This program is free software: you can redistribute it or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
        (10_103, "The license of the car and the public road: all drivers under the version of the law"),
    ]
    own = spark.createDataFrame(rows + [(i, t) for i, t in ODD], "doc_id long, text string")
    return {r.doc_id: r for r in op.scan_licenses(documents.select("doc_id", "text").unionByName(own).withColumnRenamed("doc_id", "i").selectExpr(
        "CASE WHEN i IS NULL OR i < 11 AND text IS NOT NULL AND false THEN i ELSE i END AS doc_id", "text", "'x' AS families", "1 AS match")).collect()}


def test_lines_of_the_corpus(scanned, texts_of):
    own = {d for d, _ in ODD}
    for d, text in texts_of.items():
        if d not in own:
            expected = sorted(f for f, line in LINES.items() if any(p.strip().lower() == line.lower() or p.strip().lower() == line.lower() + "." for p in text.split("\n")))
            assert scanned[d].families == expected, (d, scanned[d])


def test_own_lines(scanned):
    for i, family in enumerate(LINES):
        row = scanned[10_000 + i]
        assert row.families == [family] and row.n_paragraphs == 3 and row.n_licensed == 1
    assert scanned[10_100].families == ["gpl", "mit"] and scanned[10_100].n_licensed == 2
    assert scanned[10_102].families == ["gpl"] and 0.6 <= scanned[10_102].best_match <= 1
    assert scanned[10_103].families == []


def test_notices_inside_long_lines(scanned):
    """A notice of a few words in a line of hundreds is read in a stretch of its own."""
    assert scanned[10_101].families == ["apache"] and scanned[10_101].n_licensed == 1
    for i, family in enumerate(LINES):
        assert scanned[10_200 + i].families == [family], scanned[10_200 + i]


def test_words_in_another_order_are_no_notice(scanned):
    assert scanned[10_300].families == [] and scanned[10_301].families == []


WRAPPED = {
    "mit": "MIT License\n\nCopyright (c) 2020 Some Body\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell",
    "gpl": "# This program is free software: you can redistribute it and/or modify\r\n# it under the terms of the GNU General Public License as published by\r\n# the Free Software Foundation, either version 3 of the License",
    "lgpl": "// This library is free software; you can redistribute it and/or\n// modify it under the terms of the GNU Lesser General Public\n// License as published by the Free Software Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:",
    "reserved": "Some Body and others. All rights\nreserved.",
}


def test_wrapped_notices(spark, documents):
    """A notice is found however its lines are broken; blank lines end it."""
    rows = [(i, f"int main\n{t}\nreturn zero") for i, t in enumerate(WRAPPED.values())]
    rows += [(100, WRAPPED["bsd"] + "\n\n" + WRAPPED["gpl"]), (101, "All rights\n \nreserved."), (102, "The rights of all\nare reserved for some\nprogram of the public")]
    docs = documents.select("doc_id", "text").filter("doc_id < 0 OR doc_id > 1000").unionByName(
        documents.selectExpr("doc_id + 1000 AS doc_id", "text")).unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    lines = {(r.d, r.name) for r in op.wrapped_notices(docs.filter("doc_id < 1000")).filter("match > 0").collect()}
    assert lines == {*((i, f) for i, f in enumerate(WRAPPED)), (100, "bsd"), (100, "gpl")}
    found = {r.doc_id: r for r in op.scan_licenses(docs).collect()}
    for i, family in enumerate(WRAPPED):
        assert found[i].families == [family] and found[i].n_licensed >= 1, found[i]
    assert found[100].families == ["bsd", "gpl"] and found[102].families == []


def test_odd_cases(odd_docs, no_docs):
    df = op.scan_licenses(odd_docs)
    rows = df.collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in ODD)
    assert all(r.families == [] for r in rows) and {r.n_paragraphs for r in rows if r.doc_id in (1, 2, 3)} == {0}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert op.scan_licenses(no_docs).collect() == []


def test_all_paragraphs_train_and_calibrate(spark, monkeypatch):
    """Every line without licence counts in the model, and in the threshold by a model that didn't see it."""
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('the work of ', id, '\\nsoftware for the public\\nAll rights reserved.\\n\\nplain') AS text")
    seen, judged, training, calibrated = [], [], op._training, op.calibrated

    def counted(negatives, examples, most):
        seen.append(negatives.agg({"n": "sum"}).first()[0] or 0)
        rows = training(negatives, examples, most)
        assert (rows.filter("label = 0").agg({"weight": "sum"}).first()[0] or 0) == pytest.approx(min(most, seen[-1]))
        return rows

    monkeypatch.setattr(op, "_training", counted)
    monkeypatch.setattr(op, "calibrated", lambda rows: judged.append(rows.agg({"n": "sum"}).first()[0]) or calibrated(rows))
    rows = op.scan_licenses(docs, negatives=10).collect()
    assert seen[0] == 120 and seen[1] + seen[2] == 120 and judged == [120]
    assert all(r.families == ["reserved"] and r.n_paragraphs == 4 and r.n_licensed == 1 for r in rows) and len(rows) == 40


def test_threshold_of_paragraphs_alike(spark):
    rows = spark.createDataFrame([(0.1, 9_990), (0.81234, 4), (0.9, 6)], "f double, n long")
    assert op.calibrated(rows, 0.0011) == 0.5 and op.calibrated(rows, 0.0007) == 0.8124
    assert op.calibrated(rows, 0.0005) == 0.9001 and op.calibrated(rows.filter("f < 0.5"), 0.0) == 0.5


def test_every_match_holds_a_telling_word():
    """Without the telling words, no template has as many as a match needs."""
    plain = [op._plain(t) for f in op.FAMILIES for t in op.TEMPLATES[f]]
    telling = set(op._telling())
    assert all(len(set(t) - telling) < op._needed(t) for t in plain)


def test_words_and_lines_are_told_as_before(spark):
    """All but letters and digits stands between words; lines end with a line feed, a carriage return, or both."""
    odd = "".join(map(chr, range(1, 0x250))) + "x٠y z中 ǅ\U0001d400ééİI"
    rows = [(odd,), ("",), ("a\r\nb\n\rc\r\r\nd\n",), ("\n",), (" a  b ",), ("--",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    plain = op.F.expr(r"filter(split(lower(t), r'[^\p{L}\p{N}]+'), w -> w != '')"), op.F.expr(r"split(t, r'\r\n|\r|\n')")
    for new, old in ((op.words(op.F.col("t")), plain[0]), (op._lines(op.F.col("t")), plain[1])):
        assert all(r.a == r.b for r in df.select(new.alias("a"), old.alias("b")).collect())


def test_a_text_is_cut_into_words_once(spark):
    docs = spark.createDataFrame([(1, "a b\nc")], "doc_id long, text string")
    plan = op.paragraphs(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1, plan


def test_what_no_template_can_match_is_not_kept(spark, monkeypatch):
    """Words are kept where a template may match: by one of its long words, or by enough of its short ones."""
    by_short = [op._plain(t) for f in op.FAMILIES for t in op.TEMPLATES[f] if op._matches_by_short(op._plain(t))]
    lines = [" ".join(op._plain(t)) for f in op.FAMILIES for t in op.TEMPLATES[f]] + [" ".join(w for w in t if len(w) < op.TELLING) for t in by_short]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate([*lines, "of this file with you at one copy", "can not be the car"])], "doc_id long, text string")
    kept = {r.d for r in op._read(docs, op._telling()).filter("w IS NOT NULL").collect()}
    assert kept == set(range(len(lines)))


def test_lines_are_split_without_an_expression(spark):
    """Splitting at an expression compiles it for every line; at a space it doesn't."""
    odd = "".join(map(chr, range(1, 0x250))) + "x٠y z中 ΟΔΟΣ\nΣα ǅ\U0001d400ééİI"
    docs = spark.createDataFrame([(0, odd), (1, "a\r\nb\n\rc D-e,\r\r\nd\n"), (2, " a  b "), (3, None), (4, "--\n")], "doc_id long, text string")
    read = op.paragraphs(docs)
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert r"\p{L}" not in "".join(p.split(")")[0] for p in plan.split("split(")[1:] if not p.startswith("regexp_replace")), plan
    assert "regexp_replace(lower(" in plan, plan
    line = op.F.explode(op._lines(op.F.coalesce("text", op.F.lit("")))).alias("t")
    cut = op.F.expr(r"filter(split(lower(t), r'[^\p{L}\p{N}]+'), w -> w != '')")
    told = [r.w for r in docs.select("doc_id", line).select(cut.alias("w")).collect() if r.w]
    joined = {}
    for r in read.filter("part % 2 = 0").orderBy("d", "p_at", "part").collect():
        joined.setdefault((r.d, r.p_at), []).extend(r.w)
    assert list(joined.values()) == told
