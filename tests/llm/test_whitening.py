import math
from fractions import Fraction

import numpy as np
import pytest

from gridpulse.llm import charpoly, whitening as op

SCHEMA = "vec_id long, embedding array<float>, component int, x string, c double, n int"


def integers(v, scale=64, offset=1_000_000):
    return tuple(math.floor(scale * float(np.float32(c))) + offset for c in v)


def brute_force(rows, components=16):
    usable = [(i, integers(v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in usable})
    n, dim = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(dim)]
    centred = np.array([[float(Fraction(n * x[j] - sums[j], n)) for j in range(dim)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    rank = np.linalg.matrix_rank(centred)
    values, vectors = values[::-1][: min(components, rank)], vectors[:, ::-1][:, : min(components, rank)]
    out = {}
    for i, x in usable:
        c = [n * a - s for a, s in zip(x, sums, strict=True)]
        w = (np.array([float(Fraction(a, n)) for a in c]) @ vectors) / np.sqrt(values)
        out.setdefault((i, x), (sum(a * a for a in c), w))
    return n, usable, out, values / (np.trace(centred.T @ centred) / n), values


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "x", 0.5, 3) for i, v in rows], SCHEMA).repartition(3)
    return op.whiten(df, **options).collect()


def compare(found, rows):
    """Every component up to its sign, for rows told apart by id."""
    n, usable, expected, explained, values = brute_force(rows)
    assert len(found) == len(usable) * len(values)
    by_id = {i: v for (i, _), v in expected.items()}
    signs = {}
    for r in found:
        deviation, w = by_id[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9) and r.identity_error < 1e-9
        value = w[r.component - 1]
        if abs(value) > 1e-6:
            signs.setdefault(r.component, set()).add(np.sign(value) == np.sign(r.whitened))
        assert abs(r.whitened) == pytest.approx(abs(value), abs=1e-7)
    assert all(len(s) == 1 for s in signs.values())


def test_embeddings(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    compare(op.whiten(df).collect(), [(r.vec_id, r.embedding) for r in df.collect()])


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.standard_normal(6) * [5, 4, 3, 2, 1, 0.5]]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # copies count once in the fit
    rows += [(2000, None), (2001, [None] * 6), (2002, [float("nan")] * 6), (2003, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0])]
    compare(run(spark, rows), rows)
    # Vectors of another length take no part; equal ids and NULL ids give rows each.
    more = run(spark, [*rows, (3000, [1.0]), (3001, []), (5, rows[7][1]), (None, rows[8][1])])
    assert {r.vec_id for r in more}.isdisjoint({3000, 3001, 2000, 2001, 2002, 2003})
    assert len(more) == (450 + 2) * 6 and sum(r.vec_id == 5 for r in more) == 12 and sum(r.vec_id is None for r in more) == 6


def test_rank_below_the_dimension(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(a), float(b), float(a + b), float(a)]) for i, (a, b) in enumerate(rng.integers(-20, 20, (80, 2)))]
    compare(run(spark, rows), rows)


def test_equal_eigenvalues(spark):
    """A cross: all directions alike, so only the whitened covariance and the lengths are determined."""
    rows = [(2 * i + (s > 0), [float(s * (j == i)) for j in range(5)]) for i in range(5) for s in (-1, 1)]
    found = run(spark, rows)
    assert len(found) == 50 and all(r.explained == pytest.approx(0.2) and r.identity_error < 1e-12 for r in found)
    lengths = {i: sum(r.whitened**2 for r in found if r.vec_id == i) for i in range(10)}
    assert all(v == pytest.approx(5) for v in lengths.values())


def test_few_rows_and_empty(spark):
    assert run(spark, [(1, [0.5, 0.25])]) == [] and run(spark, [(1, None)]) == [] and run(spark, [(1, []), (2, [])]) == []
    assert run(spark, [(1, [0.5, 0.25])] * 4) == []
    found = run(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0])])
    assert [(r.component, abs(r.whitened)) for r in found] == [(1, pytest.approx(1)), (1, pytest.approx(1))]


def test_huge_entries(spark):
    """Sums stay exact beyond 64 bits; what fits no column is NULL."""
    rows = [(i, [float(np.float32(i * 1e13)), float(i % 7), 1e38]) for i in range(40)]
    found = run(spark, rows)
    assert {r.component for r in found} == {1, 2} and all(r.identity_error < 1e-9 for r in found)
    assert all(r.deviation is None or r.deviation >= 0 for r in found) and any(r.deviation is None for r in found)


def test_polynomial_and_roots():
    rng = np.random.default_rng(6)
    a = rng.integers(-9, 9, (7, 7))
    g = (a @ a.T).tolist()
    primes = charpoly.primes_below(1 << 31, charpoly.coefficient_bits(sum(g[i][i] for i in range(7)), 7) // 30 + 1)
    poly = charpoly.combined({p: charpoly.polynomial_mod(np.array(g), p).tolist() for p in primes})
    # Faddeev-LeVerrier in fractions gives the same coefficients.
    m, c, expected = [[0] * 7 for _ in range(7)], Fraction(1), [Fraction(1)]
    for k in range(1, 8):
        m = [[sum(g[i][x] * m[x][j] for x in range(7)) + (c if i == j else 0) for j in range(7)] for i in range(7)]
        c = -Fraction(sum(sum(g[i][x] * m[x][i] for x in range(7)) for i in range(7)), k)
        expected.append(c)
    assert poly == expected[::-1]
    roots = [n / 2**f for n, f, often in charpoly.largest_roots(poly, 7, 80) for _ in range(often)]
    assert roots == pytest.approx(sorted(np.linalg.eigvalsh(np.array(g, dtype=float)))[::-1], rel=1e-9)


def test_close_and_repeated_roots():
    poly = [1]
    for root in (5, 5, 5, 2, 10**9, 10**9 + 1, 0, 0):
        poly = [a - root * b for a, b in zip([0, *poly], [*poly, 0], strict=True)]
    found = charpoly.largest_roots(poly, 6, 100)
    assert [often for *_, often in found] == [1, 1, 3, 1]
    assert [n / 2**f for n, f, _ in found] == pytest.approx([10**9 + 1, 10**9, 5, 2], rel=1e-15)
    vectors = charpoly.null_space([[5, 0, 0], [0, 5, 0], [0, 0, 2]], found[2][:2] + (2,), 60)
    assert vectors @ vectors.T == pytest.approx(np.eye(2)) and np.abs(vectors[:, 2]).max() < 1e-12
