import random
from collections import Counter

from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from gridpulse.llm import common
from gridpulse.llm import simhash as op
from gridpulse.llm.components import components
from odd_cases import ODD


def mark(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_force(rows):
    marks = sorted({mark(t) for _, t in rows})
    root = {m: m for m in marks}

    def top(m):
        while root[m] != m:
            m = root[m]
        return m

    for i, a in enumerate(marks):
        for b in marks[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                root[top(b)] = top(a)
    least = {}
    for d, t in rows:
        if d is not None:
            m = top(mark(t))
            least[m] = min(least.get(m, d), d)
    return Counter((d, f"{mark(t):016x}", least.get(top(mark(t)))) for d, t in rows)


def found(df):
    return Counter((r.doc_id, r.fingerprint, r.component_id) for r in op.simhash_components(df).collect())


def test_odd_cases(odd_docs):
    assert found(odd_docs) == brute_force(ODD)


def test_documents(documents, texts_of):
    assert found(documents) == brute_force(list(texts_of.items()))


def test_empty(no_docs):
    assert op.simhash_components(no_docs).collect() == []


def test_every_distance_is_found_once(spark):
    """Random fingerprints with copies of 0 to 6 flipped bits: exactly the pairs of 4 bits or fewer, each once."""
    rng = random.Random(5)
    marks = set()
    for _ in range(60):
        m = rng.getrandbits(64)
        marks.add(m)
        for n in range(1, 7):
            marks.add(m ^ sum(1 << b for b in rng.sample(range(64), n)))
    marks = sorted(marks | {0, 1, (1 << 64) - 1, (1 << 63)})
    rows = [(m - (1 << 64) if m >> 63 else m, i) for i, m in enumerate(marks)]
    pairs = op.links(spark.createDataFrame(rows, "fp long, rep long")).collect()
    expected = {
        frozenset((i, j)) for i in range(len(marks)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 4
    }
    assert Counter(frozenset((r.u, r.v)) for r in pairs) == Counter(expected)


def test_exploded_keys_are_not_broadcast(spark):
    """64 rows for each fingerprint go by shuffle, although Spark takes them for one."""
    pairs = op.links(spark.range(1000).select(F.xxhash64("id").alias("fp"), F.col("id").alias("rep")))
    assert pairs.count() == 0
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_larger_tables_of_components_are_merged(spark, monkeypatch, documents, texts_of):
    """Beyond so many counted rows no join is left to file sizes."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    out = op.simhash_components(documents)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in out.collect()) == brute_force(list(texts_of.items()))
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(1000, 1100)] + [(5, 5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain + star + chain[:3], "u long, v long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, 5: 5, **{i: 5 for i in range(1000, 1100)}}


def test_stage_keeps_one_of_each_group(odd_docs):
    out = op.one_of_each_group(odd_docs)
    assert out.columns == odd_docs.columns
    groups = op.simhash_components(odd_docs).filter("doc_id = component_id").select("doc_id").distinct()
    assert sorted(r.doc_id for r in out.filter(F.col("doc_id").isNotNull()).collect()) == sorted(r.doc_id for r in groups.collect())
    assert out.filter("doc_id IS NULL").count() == 2
