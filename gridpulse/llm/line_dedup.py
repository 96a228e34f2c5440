"""Exact line dedup: the first document that holds a line keeps it, all later ones lose it.

Lines travel as a 128-bit hash with document and position. Hashes are range-partitioned and sorted by document and
position within a hash, so that one streaming pass sees the first occurrence of a line before the others. Decisions
come back as sparse bitmaps, 64 lines to a word; texts move once, when the bitmaps are applied.

A hash that a few hundredths of all lines share would fill one range partition. Such hashes are found with two
pre-aggregated counts. There are at most four for each shuffle partition, so the table of them is broadcast and their
lines are decided where they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import SPACES, ascii_lower, shuffle_partitions, stored, texts

MIN_KEY_CHARS = 10


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(docs: DataFrame, min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """A row (h1, h2, d, rid, pos) for every line whose key has at least ``min_chars`` code points."""
    lines = texts(docs).select("d", "rid", F.posexplode(_lines(F.col("t"))).alias("pos", "line"))
    keyed = lines.select("d", "rid", "pos", ascii_lower(F.btrim("line", F.lit(SPACES))).alias("key"))
    keyed = keyed.filter(F.length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"), "d", "rid", "pos")


def _hot_hashes(lines: DataFrame) -> DataFrame | None:
    """Hashes of more than a quarter of an average partition's lines, with their first document."""
    parts = shuffle_partitions(lines.sparkSession)
    bucket = F.pmod(F.col("h1"), F.lit(16 * parts))
    sizes = lines.groupBy(bucket.alias("bucket")).count().collect()  # 16 rows a partition at most
    limit = max(sum(r["count"] for r in sizes) / (4 * parts), 1000)
    large = [r["bucket"] for r in sizes if r["count"] > limit]
    if not large:
        return None
    counted = lines.filter(bucket.isin(large)).groupBy("h1", "h2")
    counted = counted.agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("first_d"))
    return counted.filter(F.col("n") > limit).select("h1", "h2", "first_d")


def _later(d: Column, first: Column) -> Column:
    return (d > first) | (d.isNull() & first.isNotNull())


def drop_bitmaps(docs: DataFrame, min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """Rows (d, rid, n_dropped, drops): bit i % 64 of word i // 64 is set where line i goes.

    Documents that keep all their lines have no row.
    """
    lines = stored(line_hashes(docs, min_chars), "line-hashes")
    hot = _hot_hashes(lines)
    cold, dropped_hot = lines, None
    if hot is not None:
        known = F.broadcast(hot)  # at most 4 rows for each shuffle partition
        cold = lines.join(known, ["h1", "h2"], "left_anti")
        dropped_hot = lines.join(known, ["h1", "h2"]).filter(_later(F.col("d"), F.col("first_d")))
        dropped_hot = dropped_hot.select("d", "rid", "pos")
    parts = shuffle_partitions(docs.sparkSession)
    in_order = Window.partitionBy("h1", "h2").orderBy(F.col("d").asc_nulls_last(), "pos")
    ranged = cold.repartitionByRange(parts, "h1", "h2").withColumn("first_d", F.first("d").over(in_order))
    dropped = ranged.filter(_later(F.col("d"), F.col("first_d"))).select("d", "rid", "pos")
    if dropped_hot is not None:
        dropped = dropped.unionByName(dropped_hot)
    words = dropped.distinct().groupBy("d", "rid", F.expr("pos div 64").cast("int").alias("word"))
    words = words.agg(F.expr("bit_or(shiftleft(1L, cast(pos % 64 AS int)))").alias("bits"))
    maps = words.groupBy("d", "rid").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("by_word"),
    )
    dense = F.transform(
        F.sequence(F.lit(0), F.array_max(F.map_keys("by_word"))),
        lambda w: F.coalesce(F.try_element_at(F.col("by_word"), w), F.lit(0).cast("long")),
    )
    return maps.select("d", "rid", "n_dropped", dense.alias("drops"))


def _kept_text(text: Column, drops: Column) -> Column:
    gone = lambda i: F.getbit(F.coalesce(F.get(drops, F.floor(i / 64).cast("int")), F.lit(0).cast("long")), i % 64)
    return F.when(drops.isNull(), text).otherwise(
        F.array_join(F.filter(_lines(text), lambda line, i: gone(i) == 0), "\n")
    )


def _with_bitmaps(left: DataFrame, bitmaps: DataFrame) -> DataFrame:
    found = bitmaps.select(F.col("d").alias("bd"), F.col("rid").alias("brid"), "n_dropped", "drops")
    # Bitmaps are far smaller than texts: hashed, so that texts needn't be sorted.
    on = left["d"].eqNullSafe(found["bd"]) & (left["rid"] == found["brid"])
    return left.join(found.hint("shuffle_hash"), on, "left")


def line_dedup(docs: DataFrame, min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines, n_dropped, kept_text and kept_sha256.

    A line's key is the line without ASCII white space at either end, A-Z lower-cased. Keys of fewer than
    ``min_chars`` code points always stay. NULL and empty texts are one empty line; a NULL doc_id ranks after every
    number, and all rows with one doc_id are one document. Repeated rows come back as often as they came.
    """
    joined = _with_bitmaps(texts(docs), drop_bitmaps(docs, min_chars))
    return joined.select(
        F.col("d").alias("doc_id"),
        F.size(_lines(F.col("t"))).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        _kept_text(F.col("t"), F.col("drops")).alias("kept_text"),
    ).withColumn("kept_sha256", F.sha2(F.col("kept_text").cast("binary"), 256))


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """``docs``, its columns unchanged but for the dropped lines in ``text`` and, where present, ``n_chars``."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    t = F.coalesce(docs["text"].cast("string"), F.lit(""))
    left = docs.select(docs["doc_id"].cast("long").alias("d"), F.xxhash64(t).alias("rid"), row)
    joined = _with_bitmaps(left, drop_bitmaps(docs, min_chars))
    text = _kept_text(F.col("row.text"), F.col("drops"))
    columns = {c: F.col("row").getField(c) for c in docs.columns}
    columns["text"] = text
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("drops").isNull(), columns["n_chars"]).otherwise(F.length(text).cast("long"))
    return joined.select(*[c.alias(name) for name, c in columns.items()])
