"""Named data-quality rules: rows that break a dropping rule go, the other rules only count."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Column of the rules a row breaks, a bit for each.
BROKEN = "_broken"


@dataclass(frozen=True)
class Rule:
    """``predicate`` is SQL over the checked table. A NULL result counts as broken."""

    name: str
    predicate: str
    drop: bool = False

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


@dataclass(frozen=True)
class Expectations:
    rules: tuple[Rule, ...]

    def keep(self, df: DataFrame) -> DataFrame:
        """Rows that satisfy every dropping rule."""
        for rule in self.rules:
            if rule.drop:
                df = df.where(F.expr(rule.predicate))
        return df

    def metrics(self, df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """Passed and failed rows per rule (and per ``by`` group), in one pass over ``df``."""
        counts = [F.count_if(rule.holds()).alias(f"_pass_{i}") for i, rule in enumerate(self.rules)]
        return self._listed(df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *counts), by)

    def flagged(self, df: DataFrame, kept: str) -> DataFrame:
        """``df`` with the bits of the rules a row breaks, and whether (column ``kept``) it breaks no dropping one."""
        bits = [F.when(rule.holds(), F.lit(0)).otherwise(F.lit(1 << i)).cast("bigint") for i, rule in enumerate(self.rules)]
        dropping = sum(1 << i for i, rule in enumerate(self.rules) if rule.drop)
        flags = df.withColumn(BROKEN, sum(bits, F.lit(0).cast("bigint")))
        return flags.withColumn(kept, F.col(BROKEN).bitwiseAND(F.lit(dropping)) == 0)

    def counted(self, flags: DataFrame) -> DataFrame:
        """The same as ``metrics``, from the bits that ``flagged`` gave."""
        holds = [F.col(BROKEN).bitwiseAND(F.lit(1 << i)) == 0 for i in range(len(self.rules))]
        counts = [F.count_if(h).alias(f"_pass_{i}") for i, h in enumerate(holds)]
        return self._listed(flags.agg(F.count(F.lit(1)).alias("_rows"), *counts), ())

    def _listed(self, totals: DataFrame, by: Sequence[str]) -> DataFrame:
        entries = F.array(
            *[
                F.struct(
                    F.lit(rule.name).alias("rule"),
                    F.lit("drop" if rule.drop else "count").alias("action"),
                    F.col(f"_pass_{i}").alias("passed"),
                    (F.col("_rows") - F.col(f"_pass_{i}")).alias("failed"),
                )
                for i, rule in enumerate(self.rules)
            ]
        )
        return totals.select(*by, F.inline(entries))

    def observe(self, df: DataFrame, name: str) -> DataFrame:
        """Counts broken rules while ``df`` is written; read them from the stream's progress."""
        broken = [F.count_if(~rule.holds()).alias(rule.name) for rule in self.rules]
        return df.observe(name, F.count(F.lit(1)).alias("rows"), *broken)
