import math
import random
from collections import Counter

import pytest

from gridpulse.llm import mtree as op

SCHEMA = "vec_id long, embedding array<float>, rank int, score double"


def brute_force(rows, every=50, k=5):
    usable = [
        (i, [math.floor(256 * float(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out, queries = Counter(), {}
    for i, v in usable:
        if i % every == 0:
            queries[i] = min(queries.get(i, v), v)
    for i, q in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in usable if j != i)
        out.update((i, n, j, -s) for n, (s, j) in enumerate(scores[:k], 1))
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 9, 0.5) for i, v in rows], SCHEMA).repartition(3)
    return Counter((r.query_id, r.rank, r.vec_id, r.score) for r in op.top_k(df, **options).collect())


@pytest.fixture
def small_pages(monkeypatch):
    """Pages, subtrees and blocks so small that every level of the tree has several."""
    for name, size in (("PIVOTS", 6), ("SUBTREE", 40), ("PAGE", 7), ("BLOCK", 5), ("FIRST_VISITS", 2)):
        monkeypatch.setattr(op, name, size)


def test_clusters_ties_and_odd_rows(spark, small_pages):
    rng = random.Random(2)
    centres = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in centres[i % 5]]) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(120)]  # copies of one row
    rows += [(50, [0.1] * 6), (50, [0.2] * 6), (2000, None), (2001, [None] * 6), (2050, [float("nan")] * 6)]
    rows += [(2100, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (2150, []), (2200, [0.5, -0.5]), (-50, [0.3] * 6), (0, [0.0] * 6)]
    assert found(spark, rows) == brute_force([(i, None if v is None else [x if x is None else _single(x) for x in v]) for i, v in rows])


def _single(x):
    import numpy as np

    return float(np.float32(x))


def test_few_rows(spark):
    rows = [(0, [0.5, 0.25]), (50, [0.5, 0.5]), (7, [-1.0, 1.0])]
    assert found(spark, rows) == brute_force(rows)


def test_large_components_stay_exact(spark, small_pages):
    rng = random.Random(8)
    rows = [(i, [_single(rng.uniform(-4e5, 4e5)) for _ in range(4)]) for i in range(120)]
    assert found(spark, rows, every=10) == brute_force(rows, every=10)


def test_embeddings(spark, sf_dir, small_pages):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert Counter((r.query_id, r.rank, r.vec_id, r.score) for r in op.top_k(df).collect()) == brute_force(rows)


def test_empty(spark):
    assert found(spark, [(0, None)]) == Counter()
    assert op.top_k(spark.createDataFrame([], SCHEMA)).collect() == []
