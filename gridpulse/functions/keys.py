from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEPARATOR = "||"  # fixed value: part of every multi-column key


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: Column | str) -> Column:
    """MD5 text key. One part: NULL stays NULL. Several parts are joined and NULL parts are skipped."""
    texts = [_column(p).cast("string") for p in parts]
    if len(texts) == 1:
        return F.md5(texts[0])
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))
