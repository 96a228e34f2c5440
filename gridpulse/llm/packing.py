"""Packing of training sequences: padding-optimal length buckets, then batches of a token budget in each bucket.

Bucket boundaries come from dynamic programming over the exact histogram of all lengths. Sequences are at most
``max_length`` long (longer texts are cut into several), so the histogram is bounded however large the corpus is. A
sequence's place in its bucket is exact: rows are numbered inside hashed slices, slices are offset by their counts. So
no bucket, whatever its share, is numbered in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import stored, texts

MAX_LENGTH, N_BUCKETS, TOKEN_BUDGET, SLICES = 4096, 16, 65_536, 1024


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def optimal_boundaries(lengths: list[int], counts: list[int], n_buckets: int) -> list[int]:
    """At most ``n_buckets`` of ``lengths`` (ascending), the last included, so that rounding up to them pads least.

    cost(i, j) is what lengths i+1 to j lose when padded to length j; best[k][j] is the least loss of the first j
    lengths in k buckets. Among equal losses fewer and shorter buckets win.
    """
    size, n = np.array(lengths, dtype=np.int64), len(lengths)
    rows = np.concatenate([[0], np.cumsum(np.array(counts, dtype=np.int64))])
    tokens = np.concatenate([[0], np.cumsum(size * np.array(counts, dtype=np.int64))])
    limit = np.iinfo(np.int64).max // 4
    best = np.full(n + 1, limit)
    best[0] = 0
    cuts, losses = [], []
    for _ in range(min(n_buckets, n)):
        new, cut = np.full(n + 1, limit), np.zeros(n + 1, dtype=np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + size[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            cut[j] = int(cost.argmin())
            new[j] = cost[cut[j]]
        best = new
        cuts.append(cut)
        losses.append(int(best[n]))
    k, j, out = int(np.argmin(losses)), n, []
    while k >= 0:
        out.append(lengths[j - 1])
        j, k = int(cuts[k][j]), k - 1
    return out[::-1]


def pack(
    docs: DataFrame,
    max_length: int = MAX_LENGTH,
    n_buckets: int = N_BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    length: Column | None = None,
) -> DataFrame:
    """A row for each sequence: doc_id, piece, n_pieces, n_tokens, bucket_length, batch_id, slot, padding.

    ``length`` counts the tokens of column ``t``, by default its words. A text of more than ``max_length`` tokens gives
    several pieces, all full but the last. Every sequence is padded to its bucket's length; a batch holds
    ``token_budget`` // bucket_length sequences (at least one) and only the last batch of a bucket holds fewer. NULL,
    empty and blank texts are one piece of no tokens, in no bucket and no batch. Repeated rows are packed each.
    """
    n = F.coalesce(word_count(F.col("t")) if length is None else length, F.lit(0)).cast("long")
    counted = texts(docs).select("d", "rid", n.alias("n"))
    n_pieces = F.greatest(F.lit(1), F.ceil(F.col("n") / max_length)).cast("int")
    pieces = counted.select("d", "rid", "n", n_pieces.alias("n_pieces")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)).alias("piece")
    )
    size = F.least(F.lit(max_length), F.col("n") - F.col("piece") * max_length)
    pieces = stored(pieces.select("d", "rid", "piece", "n_pieces", size.cast("long").alias("n_tokens")), "sequences")
    histogram = sorted(pieces.filter("n_tokens > 0").groupBy("n_tokens").count().collect())  # max_length rows at most
    columns = {"bucket_length": "long", "batch_id": "long", "slot": "int", "padding": "long"}
    empty = pieces.filter("n_tokens = 0").select(
        F.col("d").alias("doc_id"), "piece", "n_pieces", "n_tokens", *[F.lit(None).cast(t).alias(c) for c, t in columns.items()]
    )
    if not histogram:
        return empty
    bounds = optimal_boundaries([r["n_tokens"] for r in histogram], [r["count"] for r in histogram], n_buckets)
    first_batch, capacity, batches = [], [], 0
    for low, high in zip([0, *bounds], bounds, strict=False):
        rows = sum(r["count"] for r in histogram if low < r["n_tokens"] <= high)
        first_batch.append(batches)
        capacity.append(max(1, token_budget // high))
        batches += -(-rows // capacity[-1])
    bucket = F.coalesce(*[F.when(F.col("n_tokens") <= b, F.lit(i)) for i, b in enumerate(bounds)])
    order = F.xxhash64("d", "rid", "piece")
    placed = pieces.filter("n_tokens > 0").withColumns({"bucket": bucket, "order": order})
    placed = placed.withColumn("slice", F.pmod("order", F.lit(SLICES)))
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("bucket", "slice").count()
    offsets = offsets.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    inside = Window.partitionBy("bucket", "slice").orderBy("order", "d", "rid", "piece")
    placed = placed.withColumn("at", F.row_number().over(inside) - 1)
    placed = placed.join(F.broadcast(offsets), ["bucket", "slice"])  # n_buckets * SLICES rows at most
    of_bucket = lambda values: F.get(F.array(*[F.lit(v).cast("long") for v in values]), F.col("bucket"))
    place, room = F.col("before") + F.col("at"), of_bucket(capacity)
    packed = placed.select(
        F.col("d").alias("doc_id"),
        "piece",
        "n_pieces",
        "n_tokens",
        of_bucket(bounds).alias("bucket_length"),
        (of_bucket(first_batch) + F.floor(place / room)).cast("long").alias("batch_id"),
        (place % room).cast("int").alias("slot"),
        (of_bucket(bounds) - F.col("n_tokens")).alias("padding"),
    )
    return packed.unionByName(empty)
