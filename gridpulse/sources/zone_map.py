"""Zone maps: what every file of a table holds, so that a read opens only files that can match.

For each file the smallest and largest value of some columns, and for others a Bloom filter of the values, as bitmaps.
The map is two tables of its own, built in one pass after a rewrite, and read instead of the files' footers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridpulse.sources.tables import Layer

# Bits of one bitmap, given by Spark's bitmap functions; a filter has as many bitmaps as its map was built with.
BITMAP_BITS = 32_768
BITMAPS, HASHES = 16, 3


@dataclass(frozen=True)
class ZoneMap:
    """The zone map of the table ``layer`` (a folder), kept in folder ``path``."""

    layer: Layer
    path: str
    ranges: StructType
    bitmaps: int

    @classmethod
    def build(
        cls, layer: Layer, path: str, ranges: Sequence[str] = (), members: Sequence[str] = (), bitmaps: int = BITMAPS
    ) -> ZoneMap:
        """Reads the columns once: ``ranges`` get a smallest and largest value, ``members`` a Bloom filter.

        A filter of 16 bitmaps tells about 50,000 different values of a file apart from others with few false hits;
        more values make more of those, never a miss.
        """
        rows = layer.read().select("*", F.col("_metadata.file_path").alias("_file"))
        bounds = [f(c).alias(f"{name}_{c}") for c in ranges for name, f in (("least", F.min), ("most", F.max))]
        table = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"), *bounds)
        table.write.parquet(f"{path}/ranges")
        for c in members:
            bit = F.explode(F.array(*_bits(F.col(c), bitmaps))).alias("bit")
            spread = rows.where(F.col(c).isNotNull()).select("_file", bit)
            spread = spread.withColumn("bitmap", F.floor(F.col("bit") / BITMAP_BITS))
            filters = spread.groupBy("_file", "bitmap").agg(F.bitmap_construct_agg(F.col("bit") % BITMAP_BITS).alias("bits"))
            filters.write.parquet(f"{path}/members/{c}")
        return cls(layer, path, table.schema, bitmaps)

    def files(
        self, between: Mapping[str, tuple[object, object]] | None = None, equals: Mapping[str, Sequence[object]] | None = None
    ) -> DataFrame:
        """Files (``_file``, ``_rows``) that may hold rows with every column of ``between`` in its closed range, and
        every column of ``equals`` at one of its values."""
        spark, found = self.layer.spark, self.layer.spark.read.schema(self.ranges).parquet(f"{self.path}/ranges")
        for c, (least, most) in (between or {}).items():
            found = found.where((F.col(f"most_{c}") >= F.lit(least)) & (F.col(f"least_{c}") <= F.lit(most)))
        for c, values in (equals or {}).items():
            found = found.join(self._holders(spark, c, values), "_file", "left_semi")
        return found.select("_file", "_rows")

    def read(
        self, between: Mapping[str, tuple[object, object]] | None = None, equals: Mapping[str, Sequence[object]] | None = None
    ) -> DataFrame:
        """The table's rows that match, from the files that may hold them; the driver sees the names of those files."""
        names = [r["_file"] for r in self.files(between, equals).select("_file").collect()]
        spark, schema = self.layer.spark, self.layer.read().schema
        rows = spark.read.schema(schema).option("basePath", self.layer.path).parquet(*names) if names else spark.createDataFrame([], schema)
        for c, (least, most) in (between or {}).items():
            rows = rows.where(F.col(c).between(F.lit(least), F.lit(most)))
        for c, values in (equals or {}).items():
            rows = rows.where(F.col(c).isin(list(values)))
        return rows

    def _holders(self, spark: SparkSession, column: str, values: Sequence[object]) -> DataFrame:
        """Files whose filter has all bits of one of ``values``."""
        kind = StructType([self.layer.read().schema[column]])
        wanted = spark.createDataFrame([(v,) for v in values], kind).select(F.col(column).alias("value"))
        wanted = wanted.select("value", F.explode(F.array(*_bits(F.col("value"), self.bitmaps))).alias("bit"))
        wanted = wanted.withColumn("bitmap", F.floor(F.col("bit") / BITMAP_BITS)).distinct()
        filters = spark.read.schema("_file STRING, bitmap BIGINT, bits BINARY").parquet(f"{self.path}/members/{column}")
        tested = filters.join(wanted, "bitmap").where(_is_set("bits", F.col("bit") % BITMAP_BITS))
        hits = tested.groupBy("_file", "value").agg(F.count(F.lit(1)).alias("hits"))
        needed = wanted.groupBy("value").agg(F.count(F.lit(1)).alias("needed"))
        return hits.join(needed, "value").where("hits = needed").select("_file").distinct()


def _bits(value: Column, bitmaps: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), value), F.lit(bitmaps * BITMAP_BITS)) for seed in range(HASHES)]


def _is_set(bits: str, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1
