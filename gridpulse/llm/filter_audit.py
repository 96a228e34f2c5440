"""Audit of quality filters applied in every order: what each removes, duplicates, removes alone and costs.

A document's failures are bits. Filters A to D come from the text alone. E marks a document that has another document's
text under a larger id: an existential self-join, a left-semi join of the documents with the smallest id of each text, on
hash, exact text and smaller id. Its ids are united with those of the other failures, the bits of a document are
combined, and counts of bit combinations for each part answer all 120 orders.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import stored, texts
from gridpulse.llm.packing import word_count

FILTERS = "ABCDE"
# A text held by more than 1 of SPREAD documents is joined in as many places as it has such shares, so at most
# 2 * SPREAD places in all; no list of such texts is longer than SPREAD.
SPREAD = 1000
# Slots of hashes that a table of shared texts is reduced to before it is sent to every task.
SLOTS = 1 << 20


def text_failures(t: Column) -> Column:
    """Bits 1, 2, 4 and 8 for failures of A (few words), B (repeated words), C (capitals) and D (symbols)."""
    n = word_count(t)
    distinct = F.size(F.array_distinct(F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")))
    bit = lambda fails, value: F.when(fails, F.lit(value)).otherwise(F.lit(0))
    return (
        bit(n < 200, 1)
        + bit(100 * distinct < 50 * n, 2)
        + bit(100 * F.regexp_count(t, F.lit("[A-Z]")).cast("long") > 3 * F.length(t).cast("long"), 4)
        + bit(t.rlike("[#$%&*|]"), 8)
    )


def later_copies(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(d, rid, part) of the ``docs`` whose text also stands under a smaller id. ``rows`` holds d and the hashes of all texts.

    Only texts whose hash occurs twice can be copies, and only they are joined. The texts of one hash meet in as many
    places as the hash has shares of 1/``SPREAD`` of all rows, so a text held by a third of all documents is spread.
    """
    counts = stored(rows.groupBy("rid", "check").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared-hashes")
    share = rows.count() // SPREAD + 1
    slot = F.pmod("rid", F.lit(SLOTS))
    slots = F.broadcast(counts.select(slot.alias("slot")).distinct())  # SLOTS numbers at most
    often = counts.filter(F.col("n") > share).select("rid", "check", F.ceil(F.col("n") / share).cast("int").alias("places"))
    often = F.broadcast(often)  # SPREAD rows at most: each stands for more than 1/SPREAD of the table
    held = texts(docs, part_of()).withColumn("check", F.xxhash64(F.lit(1), "t")).withColumn("slot", slot).join(slots, "slot", "left_semi")
    held = held.join(often, ["rid", "check"], "left").withColumn("places", F.coalesce("places", F.lit(1)))
    first = held.groupBy("rid", "check", "t", "places").agg(F.min("d").alias("first"), F.max("d").alias("last")).filter("first < last")
    first = first.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("places") - 1)))
    held = held.withColumn("place", F.pmod(F.xxhash64("d"), "places").cast("int"))
    o = first.select(*[F.col(c).alias(f"o_{c}") for c in ("rid", "check", "t", "place", "first")])
    equal = [F.col(c) == F.col(f"o_{c}") for c in ("rid", "check", "t", "place")]
    return held.join(o, [*equal, F.col("o_first") < F.col("d")], "left_semi").select("d", "rid", "part")


def with_steps(df: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every row of ``df`` once for each order of the filters and each step: filter_order, step, its bit, the bits before."""
    orders = F.split(F.lit(",".join(map("".join, permutations(filters)))), ",")
    steps = df.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
    bit = lambda at: F.expr(f"shiftleft(1, instr('{filters}', substring(filter_order, {at}, 1)) - 1)")
    before = [F.when(F.col("step") > i, bit(i)).otherwise(F.lit(0)) for i in range(1, len(filters))]
    return steps.withColumns({"bit": bit("step"), "before": sum(before[1:], before[0])})


def part_of() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")


def failure_bits(docs: DataFrame) -> DataFrame:
    """Rows (d, rid, part, bits, n): the documents of one id, text and part, how many they are, and what they fail."""
    rows = texts(docs, part_of()).select(
        "d", "rid", "part", F.xxhash64(F.lit(1), "t").alias("check"), text_failures(F.col("t")).alias("bits")
    )
    rows = stored(rows, "text-failures")
    copies = later_copies(docs, rows).withColumn("bits", F.lit(1 << FILTERS.index("E")))
    failures = rows.withColumn("n", F.lit(1)).drop("check").unionByName(copies.withColumn("n", F.lit(0)))
    return failures.groupBy("d", "rid", "part").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A part is a value of ``lang``, NULL counting as ''. NULL texts are empty; an empty text fails A only, and E where a
    smaller id has none either. Every row of ``docs`` counts, repeated ones too. A row without id never has a smaller
    one, is no smaller one, and has no labels. Of several labels of an id one that says 1 holds. Parts without labels
    lose nothing good or toxic. An empty table gives no rows.
    """
    said = lambda c: F.coalesce(F.max(F.when(F.col(c) == 1, 1)), F.lit(0)).alias(c)
    judged = labels.select(F.col("doc_id").cast("long").alias("_id"), "quality", "toxic").filter("_id IS NOT NULL")
    judged = judged.groupBy("_id").agg(said("quality"), said("toxic"))
    judged = judged.withColumn("_null", F.lit(0).cast("long"))
    # Rows without id match no label; the second key keeps them from meeting in one task.
    known = failure_bits(docs).withColumn("_null", F.when(F.col("d").isNull(), F.col("rid")).otherwise(F.lit(0)))
    rows = known.join(judged, (F.col("d") == F.col("_id")) & (known["_null"] == judged["_null"]), "left")
    flags = [F.coalesce(c, F.lit(0)).alias(c) for c in ("quality", "toxic")]
    combinations = rows.select("part", "bits", "n", *flags).groupBy("part", "bits", "quality", "toxic").agg(F.sum("n").alias("n"))
    steps = with_steps(combinations)
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    gone = F.col("bits").bitwiseAND(F.col("before")) != 0
    passed = F.col("bits").bitwiseAND(F.col("bit") + F.col("before")) == 0
    count = lambda when, name, value=F.col("n"): F.sum(F.when(when, value).otherwise(F.lit(0))).cast("long").alias(name)
    # A document is removed by its first failing filter: each of its k failures comes first in 120 / k orders.
    orders = F.col("n") * F.floor(F.lit(120) / F.greatest(F.lit(1), F.bit_count("bits")))
    return steps.groupBy("part", "filter_order", "step").agg(
        count(passed, "kept"),
        count(hit & ~gone, "removed"),
        count(hit & gone, "redundant"),
        count(F.col("bits") == F.col("bit"), "unique_fails"),
        count(hit & ~gone & (F.col("quality") == 1), "good_lost"),
        count(hit & ~gone & (F.col("toxic") == 1), "toxic_lost"),
        count(hit, "shapley", orders),
    )
