"""Mixing of sources by a time-varying curriculum, with built-in functions only.

Every source has a weight schedule, a piecewise linear rate over training time 0 to 1. Its integral is the source's
weight; the weights share the training budget, where no source gives more than ``max_repeats`` times its words. A source's
cumulative demand is its target times the schedule's integral up to t, over the whole integral. Its documents stand in a
hashed order, one copy of the source after the other, and the words before a copy, put into the inverted demand, are the
time at which training reaches it. Range-sorted by that time, the documents are in training order.

Running sums are taken inside (source, hash block) groups and blocks are offset by their sums. There are about as many
blocks as rows in a block, so a source with a third of all rows is summed by many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import stored, texts
from gridpulse.llm.packing import word_count

Schedule = Sequence[tuple[float, float]]  # (time, weight) points, times rising from 0 to 1

# Dealt to the sources in turn: falling, even and rising, with integrals 3, 1 and 2.
SCHEDULES: tuple[Schedule, ...] = (((0.0, 4.0), (1.0, 2.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.0), (0.5, 2.0), (1.0, 3.0)))
BUDGET, MAX_REPEATS = 1.5, 2
HASH_BITS = 60


def integral(schedule: Schedule) -> float:
    """The schedule's weight: what it adds up to over all of training."""
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False))


def time_of_share(share: Column, schedule: Schedule) -> Column:
    """The time at which the schedule's integral reaches ``share`` (0 to 1) of its whole; where it rests, the end of the rest."""
    pieces, area = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        gain = (t1 - t0) * (w0 + w1) / 2
        if gain > 0:
            pieces.append((t0, w0, (w1 - w0) / (t1 - t0), area, area + gain))
            area += gain
    if not pieces:
        return F.lit(None).cast("double")
    reached, times = share * F.lit(area), []
    for t0, w0, slope, low, high in pieces:
        rest = reached - F.lit(low)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * rest))
        times.append((high, F.when(rest <= 0, F.lit(t0)).otherwise(F.lit(t0) + F.lit(2.0) * rest / (F.lit(w0) + root))))
    out = times[-1][1]
    for high, time in reversed(times[:-1]):
        out = F.when(reached < F.lit(high), time).otherwise(out)
    return F.least(F.lit(1.0), out)


def numbered(df: DataFrame, order: Column, name: str) -> DataFrame:
    """Column ``name``: the row's exact place in ``order``, from 0. Rows are sorted by range, no task sees all of them."""
    placed = df.repartitionByRange(order).sortWithinPartitions(order)
    placed = stored(placed.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumn("_part", part)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    starts = placed.groupBy("_part").count().withColumn("_start", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    return placed.join(starts, "_part").withColumn(name, F.col("_start") + row).drop("_part", "_start", "_at")


def with_targets(sources: DataFrame, budget: float, max_repeats: int) -> DataFrame:
    """``sources`` (words, weight) with ``target``: budget * words shared by weight, ``max_repeats`` times a source's own at most.

    What a source cannot give is shared again by the weights of the others. All open sources stand at one level, words
    a unit of weight, which rises until nobody new is above its bound; the driver sees two sums a round.
    """
    cap = F.col("words") * max_repeats
    total = sources.agg(F.sum("words")).first()[0] or 0
    level, above = 0.0, -1
    while True:
        full = cap < F.col("weight") * F.lit(level)
        row = sources.agg(
            F.count_if(full).alias("above"),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if row["above"] == above or row["open"] == 0:
            break
        level, above = (budget * total - row["given"]) / row["open"], row["above"]
    return sources.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(level)))


def mixture(
    docs: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    budget: float = BUDGET,
    max_repeats: int = MAX_REPEATS,
    schedule_of: Column | None = None,
) -> DataFrame:
    """A row for each document, in training order: doc_id, rid, source, size, source_size, target, taken, position, copies.

    ``schedule_of`` is the number of a source's schedule, an expression over ``source`` and ``rank`` (place of the source
    by code point, NULL last); by default the schedules are dealt in turn. ``copies`` lists each use of the document:
    its number, its time in training and the words taken. ``taken`` adds them up, ``position`` is the first time. A
    source's last copy is cut at the target, so that its words add up to the rounded target exactly.

    NULL texts have no words. Documents without words, and those beyond the target, have no copies, taken 0 and a NULL
    position; they come last. A NULL source is a source of its own, and '' another. Equal ids stand side by side
    in their source's order, repeated rows each take their own words; which of two equal rows comes first shows in
    nothing. The order hashes ids only, so reruns agree. An empty table gives no rows.
    """
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("d").cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")
    name = F.coalesce(F.concat(F.lit("="), F.col("s")), F.lit(""))  # never NULL, so that joins and windows agree on it
    rows = texts(docs, F.col("source").cast("string").alias("s"))
    rows = stored(rows.select("d", "rid", name.alias("s"), word_count(F.col("t")).cast("long").alias("size"), key.alias("key")), "sizes")
    bits = max(0, math.ceil(math.log2(max(1, rows.count())) / 2))
    block = F.shiftright("key", HASH_BITS - bits)
    blocks = stored(rows.groupBy("s", block.alias("block")).agg(F.sum("size").alias("words")), "block-sizes")

    source = F.when(F.col("s") != "", F.expr("substring(s, 2)"))
    sources = blocks.groupBy("s").agg(F.sum("words").alias("words")).withColumn("source", source)
    sources = numbered(sources, F.col("source").asc_nulls_last(), "rank")
    turn = F.col("rank") % len(schedules) if schedule_of is None else schedule_of
    weights = F.array(*[F.lit(float(integral(x))) for x in schedules])
    sources = sources.withColumn("turn", turn.cast("int")).withColumn("weight", F.get(weights, F.col("turn")))
    sources = stored(with_targets(stored(sources, "sources"), budget, max_repeats), "targets")

    before = Window.partitionBy("s").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    starts = starts.join(sources.select("s", F.col("words").alias("source_size"), "target", "turn"), "s")
    inside = Window.partitionBy("s", "block").orderBy("key", "d", "rid").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("block", block).join(starts, ["s", "block"])
    placed = placed.withColumn("first", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))

    demand = F.floor(F.col("target") + 0.5)
    copy = lambda k: F.col("first") + k * F.col("source_size")
    words = lambda k: F.greatest(F.lit(0), F.least(F.col("size"), demand - copy(k)))
    time = lambda k: F.coalesce(
        *[F.when(F.col("turn") == i, time_of_share(F.try_divide(copy(k), F.col("target")), x)) for i, x in enumerate(schedules)]
    )
    uses = [F.struct(F.lit(k).alias("copy"), time(k).alias("position"), words(k).cast("long").alias("words")) for k in range(max_repeats)]
    copies = F.filter(F.array(*uses), lambda u: u["words"] > 0)
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda a, u: a + u["words"])
    mixed = placed.select("d", "rid", "key", source.alias("source"), "size", "source_size", "target", copies.alias("copies"))
    mixed = mixed.withColumns({"taken": taken, "position": F.get("copies", F.lit(0))["position"]})
    place = [F.col("position").asc_nulls_last(), F.col("key"), F.col("rid")]
    ordered = stored(mixed, "mixture").repartitionByRange(*place).sortWithinPartitions(*place)
    return ordered.select(F.col("d").alias("doc_id"), "rid", "source", "size", "source_size", "target", "taken", "position", "copies")


def training_order(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The texts as training reads them, a row for each copy: position, doc_id, source, copy, words, text, range-sorted.

    A copy that the mix takes in part has its first ``words`` words, with single spaces between them.
    """
    uses = mixed.select("doc_id", "rid", "source", "size", F.explode("copies").alias("use"))
    whole = texts(docs).dropDuplicates(["d", "rid"])  # repeated rows have one text, and as many uses as there are rows
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("rid") == F.col("_rid"))
    joined = uses.join(whole.withColumnRenamed("rid", "_rid"), same)
    split = F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.when(F.col("use.words") < F.col("size"), F.array_join(F.slice(split, 1, F.col("use.words").cast("int")), " "))
    out = joined.select(
        "use.position", "doc_id", "source", "use.copy", "use.words", F.coalesce(text, F.col("t")).alias("text"), F.col("rid").alias("_rid")
    )
    place = ["position", "doc_id", "_rid", "copy"]
    return stored(out, "training-order").repartitionByRange(*place).sortWithinPartitions(*place).drop("_rid")
