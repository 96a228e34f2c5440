"""The pipeline, stage by stage, against brute force over each stage's own input."""

import os

import duckdb
import pytest

import corpus_pipeline as cp
from gridpulse.llm.common import stored
from gridpulse.llm.queries import ORACLES, QUERIES
from test_line_dedup import key
from test_packing import check
from test_simhash import brute_force as simhash_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf_dir, documents):
    docs, inputs = documents, {}
    for name, stage in cp.STAGES:
        inputs[name] = {r.doc_id: r.text for r in docs.collect()}
        docs = stored(stage(spark, docs, sf_dir), "stage")
        if name != cp.STAGES[-1][0]:
            assert docs.columns == COLUMNS
    last = docs.collect()
    names = [n for n, _ in cp.STAGES]
    assert names == ["language_id", "line_dedup", "simhash_dedup", "decontaminate", "packing"]
    assert inputs["line_dedup"].keys() == inputs["language_id"].keys()  # every document has a language

    first = {}
    for d, t in sorted(inputs["line_dedup"].items()):
        for line in t.split("\n"):
            first.setdefault(key(line), d)
    for d, t in inputs["line_dedup"].items():
        kept = "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] == d)
        assert inputs["simhash_dedup"][d] == kept

    components = simhash_of(list(inputs["simhash_dedup"].items()))
    assert inputs["decontaminate"].keys() == {c for _, _, c in components}

    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    leaked = {d for d, t in inputs["decontaminate"].items() if any(x in t for x in items.values())}
    assert not leaked & inputs["packing"].keys()
    assert len(inputs["packing"]) >= len(inputs["decontaminate"]) - 2 * len(leaked) - 2
    check(last, list(inputs["packing"].items()), 4096, 16, 65_536)


def test_run_equals_its_stages(spark, sf_dir):
    assert cp.run(spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf_dir, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    found = QUERIES[name](spark, sf_dir)
    assert sorted(found.columns) == sorted(names)
    assert sorted(tuple(r) for r in found.select(*names).collect()) == sorted(result.fetchall())
