"""Schemas that grow with the files."""

import json

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridpulse.session import new_folder
from gridpulse.sources.files import with_rescued_data
from gridpulse.sources.schema_log import EvolvingTable, SchemaLog, evolved_schema, with_schema


def land(spark, folder, *objects):
    lines = [(o if isinstance(o, str) else json.dumps(o),) for o in objects]
    spark.createDataFrame(lines, "value STRING").coalesce(1).write.mode("append").text(folder)


def test_columns_follow_the_files(spark):
    landing, base = new_folder(spark, "landing"), new_folder(spark, "table")
    evolving = EvolvingTable(spark, landing, base)
    land(spark, landing, {"id": 1, "score": 4})
    assert evolving.run().input_rows == 1 and evolving.run().input_rows == 0
    assert evolving.log.versions() == {1: StructType.fromDDL("id BIGINT, score BIGINT")}
    land(spark, landing, {"id": 2, "score": 4.5, "home": True, "size": 7}, {"id": 3, "home": False, "size": 8.25, "at": {"x": 1}}, "no json")
    evolving.run()
    second = StructType.fromDDL("id BIGINT, score DOUBLE, at STRING, home BOOLEAN, size DOUBLE")
    assert evolving.log.latest() == (2, second)
    land(spark, landing, {"id": 4, "score": 1, "size": "big", "home": None})
    evolving.run()
    assert evolving.log.latest()[0] == 3 and evolving.log.latest()[1]["size"].dataType.simpleString() == "string"
    # A new start of the program finds the log.
    found = EvolvingTable(spark, landing, base).read()
    rows = {r.id: (r.score, r["at"], r.home, r.size, r["_rescued_data"]) for r in found.collect()}
    assert rows == {
        1: (4.0, None, None, None, None),
        2: (4.5, None, True, "7", None),
        3: (None, '{"x":1}', False, "8.25", None),
        4: (1.0, None, None, "big", None),
        None: (None, None, None, None, '{"_corrupt_record":"no json"}'),
    }
    assert {f.rsplit(".", 1)[-1] for f in (r.source_file for r in found.collect())} == {"txt"}


def test_what_all_values_fit(spark):
    schema = StructType.fromDDL("a INT, b INT, c DOUBLE")
    texts = [{"a": 3_000_000_000, "b": 1.5, "c": "x", "n": 1, "m": "1", "t": True}, {"a": 1, "n": "2.5", "m": "one", "t": "false", "z": None}]
    df = with_rescued_data(spark.createDataFrame([(json.dumps(t),) for t in texts], "value STRING"), schema)
    wider = evolved_schema(schema, df)
    assert wider == StructType.fromDDL("a BIGINT, b DOUBLE, c STRING, m STRING, n DOUBLE, t BOOLEAN")
    first, second = with_schema(df, wider).orderBy(F.desc("a")).collect()
    assert (first.a, first.b, first.c, first.n, first.t, first["_rescued_data"]) == (3_000_000_000, 1.5, "x", 1.0, True, None)
    assert (second.a, second.m, second.n, second.t) == (1, "one", 2.5, False)
    assert evolved_schema(schema, df.where("FALSE")) == schema


def test_log_keeps_versions(spark):
    log = SchemaLog(spark, new_folder(spark, "schemas"))
    assert log.latest() is None and log.versions() == {}
    one, two = StructType.fromDDL("a INT"), StructType.fromDDL("a INT, b STRING")
    assert [log.add(one), log.add(one), log.add(two), log.add(two)] == [1, 1, 2, 2]
    assert SchemaLog(spark, log.folder).versions() == {1: one, 2: two}
