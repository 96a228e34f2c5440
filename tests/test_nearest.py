"""Nearest opponent: the array form, the block search and a plain all-pairs check must agree."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from gridpulse.operators.nearest import SMALL_GROUP, _arrays, _large_groups, nearest_per_group

SCHEMA = "g STRING, t INT, id STRING, x DOUBLE, y DOUBLE"


def brute_force(lefts, rights, on):
    """Nearest id and distance per left key, from every pair; ``on`` are positions in the rows."""
    best = {}
    for left in lefts:
        for right in rights:
            if any(left[i] is None or left[i] != right[i] for i in on):
                continue
            places = [left[3], left[4], right[3], right[4]]
            known = all(v is not None and math.isfinite(v) for v in places)
            d = math.sqrt((left[3] - right[3]) ** 2 + (left[4] - right[4]) ** 2) if known else None
            rank = (d is None, d or 0.0, right[2])
            if left[:3] not in best or rank < best[left[:3]][0]:
                best[left[:3]] = (rank, d)
    return {key: (rank[2], d) for key, (rank, d) in best.items()}


def search(spark, lefts, rights, on=("g", "t"), **sizes):
    result = nearest_per_group(
        spark.createDataFrame(lefts, SCHEMA), spark.createDataFrame(rights, SCHEMA),
        on=on, left_keys=["g", "t", "id"], right_id="id", right_name="other", x="x", y="y", **sizes,
    )
    rows = result.collect()
    found = {(r["g"], r["t"], r["id"]): (r["other"], r["separation"]) for r in rows}
    assert len(found) == len(rows)
    return found


def points(rng, n, prefix, groups=1, spread=100.0, digits=2):
    return [
        (f"g{rng.randrange(groups)}", 0, f"{prefix}{i}", round(rng.uniform(0, spread), digits), round(rng.uniform(0, spread), digits))
        for i in range(n)
    ]


@pytest.mark.parametrize("sizes", [{}, {"small_group": 1, "leaf_size": 4}, {"small_group": 60, "leaf_size": 8}])
def test_random_points(spark, sizes):
    rng = random.Random(3)
    lefts, rights = points(rng, 300, "l", groups=3), points(rng, 250, "r", groups=3)
    assert search(spark, lefts, rights, **sizes) == brute_force(lefts, rights, (0, 1))


@pytest.mark.parametrize("sizes", [{}, {"small_group": 1, "leaf_size": 2}])
def test_clusters_far_apart_and_on_a_line(spark, sizes):
    rng = random.Random(5)
    lefts = points(rng, 150, "l", spread=1.0)
    rights = [(g, t, i, x + 500, y) for g, t, i, x, y in points(rng, 150, "r", spread=1.0)]
    rights += [("g0", 0, f"s{i}", 500.0, float(i)) for i in range(40)]
    assert search(spark, lefts, rights, **sizes) == brute_force(lefts, rights, (0, 1))


@pytest.mark.parametrize("sizes", [{}, {"small_group": 1, "leaf_size": 2}])
def test_ties_copies_and_missing_places(spark, sizes):
    lefts = [
        ("a", 1, "p", 0.0, 0.0), ("a", 1, "p", 0.0, 0.0), ("a", 1, "q", None, 1.0), ("a", 1, "n", float("nan"), 1.0),
        ("b", 1, "p", 0.0, 0.0), ("c", 1, "p", 1.0, 1.0), (None, 1, "p", 0.0, 0.0), ("d", 1, "z", 2.0, 2.0),
    ]
    rights = [
        ("a", 1, "y", 3.0, 4.0), ("a", 1, "x", 4.0, 3.0), ("a", 1, "w", None, 0.0), ("a", 1, "v", float("inf"), 0.0),
        ("b", 1, "k", None, 0.0), ("b", 1, "j", 0.0, None), (None, 1, "x", 0.0, 0.0), ("d", 2, "m", 2.0, 2.0),
    ]
    found = search(spark, lefts, rights, **sizes)
    assert found == {
        ("a", 1, "p"): ("x", 5.0),
        ("a", 1, "q"): ("v", None),
        ("a", 1, "n"): ("v", None),
        ("b", 1, "p"): ("j", None),
    }
    assert found == brute_force(lefts, rights, (0, 1))


def test_several_samples_per_key_take_the_smallest(spark):
    lefts = [("a", 1, "p", 0.0, 0.0), ("a", 1, "p", 10.0, 0.0)]
    rights = [("a", 1, "r", 12.0, 0.0), ("a", 1, "s", 3.0, 0.0)]
    for sizes in ({}, {"small_group": 1, "leaf_size": 1}):
        assert search(spark, lefts, rights, **sizes) == {("a", 1, "p"): ("r", 2.0)}


def test_keys_must_contain_the_match_columns(spark):
    df = spark.createDataFrame([("a", 1, "p", 0.0, 0.0)], SCHEMA)
    with pytest.raises(ValueError):
        nearest_per_group(df, df, on=["g", "t"], left_keys=["id"], right_id="id")


coordinate = st.one_of(st.none(), st.integers(-3, 3).map(float), st.floats(-1e6, 1e6, allow_nan=False))
rows = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.just(0), st.sampled_from("pqrst"), coordinate, coordinate), min_size=1, max_size=25)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(rows, rows)
def test_both_forms_agree(spark, lefts, rights):
    expected = brute_force(lefts, rights, (0, 1))
    plain = search(spark, lefts, rights)
    assert plain == search(spark, lefts, rights, small_group=1, leaf_size=2)
    assert plain.keys() == expected.keys()
    for key, (other, distance) in expected.items():
        assert plain[key][0] == other or math.isclose(plain[key][1], distance, rel_tol=1e-12)


def test_groups_without_left_rows_are_not_gathered(spark):
    left = spark.createDataFrame([("a", 1, 0.0, 0.0)], "g STRING, id INT, x DOUBLE, y DOUBLE")
    busy = spark.range(100_000).select(F.lit("b").alias("g"), F.col("id").alias("rid"), F.lit(1.0).alias("x"), F.lit(1.0).alias("y"))
    right = busy.unionByName(spark.range(3).select(F.lit("a").alias("g"), F.col("id").alias("rid"), F.lit(2.0).alias("x"), F.col("id").cast("double").alias("y")))
    arrays = _arrays(left.select("g"), right.select("g", F.col("rid").alias("_id"), F.col("x").alias("_rx"), F.col("y").alias("_ry")), ["g"])
    assert [(r.g, r.n) for r in arrays.select("g", F.size("_others").alias("n")).collect()] == [("a", 3)]
    found = nearest_per_group(left, right, ["g"], ["g", "id"], "rid", x="x", y="y").collect()
    assert [(r.g, r.id, r.rid) for r in found] == [("a", 1, 0)]


def test_groups_of_hundreds_are_not_matched_pair_by_pair(spark):
    rng = random.Random(7)
    lefts, rights = points(rng, 400, "l"), points(rng, 400, "r")
    sides = [spark.createDataFrame(rows, SCHEMA).select("g", "t") for rows in (lefts, rights)]
    assert [(r.g, r.t) for r in _large_groups(*sides, ["g", "t"], SMALL_GROUP).frame.collect()] == [("g0", 0)]
    assert search(spark, lefts, rights) == brute_force(lefts, rights, (0, 1))
