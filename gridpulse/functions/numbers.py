from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds and labels of the score bands, highest first, and the label below them.
SCORE_BANDS = ((65.0, "Alta Confianza"), (40.0, "50/50 Incertidumbre"))
LOWEST_BAND = "Baja Confianza"


def to_number(column: Column | str, kind: str) -> Column:
    """Cast that yields NULL for text that is no number, whatever the ANSI setting."""
    return (F.col(column) if isinstance(column, str) else column).try_cast(kind)


def planar_distance(dx: Column, dy: Column) -> Column:
    """Length of (dx, dy). It never decreases when |dx| or |dy| grows, also after rounding.

    Squares are products, which is what Spark's power function yields for an exponent of two.
    """
    return F.sqrt(dx * dx + dy * dy)


def score_band(
    score: Column | str,
    bands: Sequence[tuple[float, str]] = SCORE_BANDS,
    otherwise: str = LOWEST_BAND,
) -> Column:
    """Label of the first band whose lower bound the score reaches; NULL gets the last label."""
    score = F.col(score) if isinstance(score, str) else score
    label = F.lit(otherwise)
    for bound, name in reversed(bands):
        label = F.when(score >= F.lit(bound), F.lit(name)).otherwise(label)
    return label
