"""Rules counted by the write they belong to, and kept run by run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.times import with_audit
from gridpulse.operators.quality import BROKEN, Expectations
from gridpulse.sources.tables import Layer, write_table

KEPT = "_kept"
HISTORY = "run INT, table STRING, rule STRING, action STRING, passed BIGINT, failed BIGINT, counted_at TIMESTAMP"


@dataclass(frozen=True)
class RuleHistory:
    """What every rule passed and failed in every run, as a table in folder ``path``. Runs are only added."""

    spark: SparkSession
    path: str

    def read(self) -> DataFrame:
        return self.spark.read.schema(HISTORY).parquet(self.path)

    def next_run(self) -> int:
        try:
            last = self.read().agg(F.max("run")).first()[0]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            last = None
        return 1 if last is None else last + 1

    def add(self, counts: DataFrame, table: str, run: int) -> None:
        """``counts``: rule, action, passed, failed. A run that comes again for a table replaces what it said before."""
        rows = with_audit(counts.select("rule", "action", "passed", "failed"), "counted_at")
        rows = rows.withColumns({"run": F.lit(run), "table": F.lit(table)}).coalesce(1)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("run", "table").parquet(self.path)

    def add_observed(self, observed: Mapping[str, int], expectations: Expectations, table: str, run: int) -> None:
        """The counts of a streaming write, as its report gives them (``Expectations.observe``)."""
        rows = [
            (r.name, "drop" if r.drop else "count", observed["rows"] - observed[r.name], observed[r.name]) for r in expectations.rules
        ]
        self.add(self.spark.createDataFrame(rows, "rule STRING, action STRING, passed BIGINT, failed BIGINT"), table, run)


@dataclass(frozen=True)
class CheckedTable:
    """Rows that passed the dropping rules, those that didn't, and the counts of all rules."""

    kept: Layer
    dropped: Layer
    counts: DataFrame


def write_checked(df: DataFrame, expectations: Expectations, path: str, partition_by: Sequence[str] = ()) -> CheckedTable:
    """Writes ``df`` once, with the rules each row breaks, to ``path``: kept and dropped rows in folders of their own.

    The counts come from what was written, one number a row, so that nothing is computed twice. (Spark's ``Observation``
    would count during the write, but a forest fitted in the same session could no longer score.)
    """
    spark, flagged = df.sparkSession, expectations.flagged(df, KEPT)
    write_table(flagged, path=path, partition_by=[KEPT, *partition_by])
    layers = []
    for kept in ("true", "false"):
        folder = f"{path}/{KEPT}={kept}"
        # A folder without rows does not exist otherwise.
        spark.createDataFrame([], df.schema).write.mode("append").partitionBy(*partition_by).parquet(folder)
        layers.append(Layer(spark, path=folder, schema=df.schema))
    flags = spark.read.schema(f"{BROKEN} BIGINT").parquet(path)
    return CheckedTable(*layers, expectations.counted(flags.select(BROKEN)))
