"""SimHash near-duplicates found by equality joins on deletion variants.

With at most four differing bits and three segments, one segment differs in at most one bit. So every distinct
fingerprint is indexed under each segment with each single bit left out: 64 keys. Two fingerprints within the distance
share a key. The join on that key compares the whole fingerprints, and only their first common key gives a row, so each
link comes out once. Links join fingerprints, never documents: copies of one text are one node, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from gridpulse.llm.common import merged_beyond, stored, texts
from gridpulse.llm.components import components

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
SEGMENTS = ((0, 21), (21, 21), (42, 22))  # first bit and width; one more than half the distance


def fingerprint(words: list[bytes], size: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if more than half of the shingles' hashes have it; zero without words."""
    if not words:
        return 0
    if len(words) <= size:
        return xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - size + 1
    counts = np.zeros(64, dtype=np.int64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    for start in range(0, n, 65536):
        part = min(65536, n - start)
        hashes = np.fromiter((xxh64_intdigest(next(grams), SEED) for _ in range(part)), dtype="<u8", count=part)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (d, fp): doc_id and the fingerprint of the text as a signed long."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("t")
            found = [fingerprint(column[i].as_py().lower().split(), size) for i in range(batch.num_rows)]
            fp = pa.array(np.array(found, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("d"), fp], names=["d", "fp"])

    return texts(docs).select("d", F.col("t").cast("binary").alias("t")).mapInArrow(of, "d long, fp long")


def _mask(first: int, width: int) -> int:
    return int(np.uint64(((1 << width) - 1) << first).view(np.int64))


def _keys(fp: Column) -> Column:
    """Segment number and left-out bit above, the segment without that bit below."""
    keys = []
    for s, (first, width) in enumerate(SEGMENTS):
        segment = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))
        for j in range(width):
            tag = F.lit((64 * s + j) << 32)
            keys.append(segment.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << j))).bitwiseOR(tag))
    return F.explode(F.array(*keys))


def _first_tag(differing: Column) -> Column:
    """The first key that two fingerprints share: the first segment with at most one differing bit, that bit or 0."""
    tag = F.lit(None).cast("long")
    for s, (first, width) in reversed(list(enumerate(SEGMENTS))):
        part = F.shiftrightunsigned(differing.bitwiseAND(F.lit(_mask(first, width))), first)
        place = F.when(part == 0, F.lit(0)).otherwise(F.bit_count(part - 1))
        tag = F.when(F.bit_count(part) <= 1, F.lit(64 * s) + place).otherwise(tag)
    return tag.cast("long")


def links(classes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Pairs (u, v) of ``rep`` for fingerprints at most ``max_distance`` bits apart; ``classes``: fp, rep."""
    if not 0 <= max_distance <= MAX_DISTANCE:
        raise ValueError("three segments find distances of at most 4 bits")
    variants = classes.select(_keys(F.col("fp")).alias("key"), "fp", "rep")
    a, b = variants.toDF("key", "fa", "ra"), variants.toDF("key", "fb", "rb")
    differing = F.col("fa").bitwiseXOR(F.col("fb"))
    near = (F.bit_count(differing) <= max_distance) & (_first_tag(differing) == F.shiftright("key", 32))
    # Spark sizes a table after an explode like one before it, and would broadcast 64 times what it counts.
    pairs = a.join(b.hint("merge"), "key").filter((F.col("fa") < F.col("fb")) & near)
    return pairs.select(F.col("ra").alias("u"), F.col("rb").alias("v"))


def simhash_components(
    docs: DataFrame, size: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE
) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, n_links of its fingerprint.

    Texts are A-Z lower-cased and split at ASCII white space; shingles count as often as they occur. A text of fewer
    words than a shingle is one shingle; NULL, empty and blank texts have fingerprint zero and link to each other and
    to anything within the distance. component_id is the smallest doc_id of the component. Rows without doc_id get the
    component of their fingerprint, NULL if all its rows lack an id.
    """
    marks = stored(fingerprints(docs, size), "fingerprints")
    classes = marks.groupBy("fp").agg(F.min("d").alias("rep"))
    pairs = stored(links(classes.filter("rep IS NOT NULL"), max_distance), "links")
    roots, n = components(pairs), pairs.count()
    degree = pairs.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    known = classes.join(merged_beyond(roots, n), F.col("rep") == F.col("node"), "left").drop("node")
    known = known.join(merged_beyond(degree, n), F.col("rep") == F.col("node"), "left")
    known = known.select(
        F.col("fp").alias("cfp"),
        F.coalesce("root", "rep").alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )
    joined = marks.join(known.hint("merge"), F.col("fp") == F.col("cfp"))
    return joined.select(
        F.col("d").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links"
    )


def one_of_each_group(docs: DataFrame, size: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with only the smallest doc_id of each component, once; rows without doc_id all stay."""
    found = simhash_components(docs, size, max_distance)
    winners = found.filter("doc_id = component_id").select(F.col("doc_id").alias("__winner")).distinct()
    kept = docs.filter(F.col("doc_id").isNotNull())
    kept = kept.join(winners, kept["doc_id"].cast("long") == winners["__winner"], "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.filter(F.col("doc_id").isNull()))
