"""Joins of a fact table with its dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dimension:
    """A dimension in one role: its key, the fact column it meets, and the attributes to add."""

    frame: DataFrame
    key: str
    fact_key: str
    attributes: dict[str, str]  # output name -> dimension column


def star_join(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Inner joins, one per role. The same table may appear in several roles.

    No broadcast is forced: Spark broadcasts a dimension whose measured size is below its threshold
    and shuffles a larger one.
    """
    for i, d in enumerate(dimensions):
        side = d.frame.select(F.col(d.key).alias(f"_k{i}"), *[F.col(c).alias(name) for name, c in d.attributes.items()])
        fact = fact.join(side, F.col(d.fact_key) == F.col(f"_k{i}")).drop(f"_k{i}")
    return fact
