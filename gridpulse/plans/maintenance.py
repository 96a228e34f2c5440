"""Periodic rewrite of a table: many small files to few, ordered for skipping, with fresh statistics."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from gridpulse.operators.layout import zorder_layout
from gridpulse.sources.tables import Layer, analyze_table, write_table

# Properties that Spark keeps for itself.
INTERNAL = ("spark.sql.", "transient_", "numFiles", "totalSize", "rawDataSize", "numRows")


def optimize(
    source: Layer,
    zorder_by: Sequence[str],
    path: str | None = None,
    files: int | None = None,
    name: str | None = None,
) -> Layer:
    """Rewrites ``source`` in Z-order and returns the result.

    A table given by name is replaced under its own name: the copy is written aside (at ``path``, or next
    to the table), gets the table's partitioning, comment, properties and fresh statistics,
    and only then takes the name. The old table's name goes; files of an external table stay where they are.

    A folder is copied to ``path``; with ``name`` that name is pointed at the copy.
    """
    if source.name:
        return _replace(source, zorder_by, path, files)
    if path is None:
        raise ValueError("a folder is copied to a path of its own")
    table = zorder_layout(source.read(), zorder_by, files)
    write_table(table, name=name, path=path)
    if name:
        analyze_table(source.spark, name, columns=zorder_by)
        return Layer(source.spark, name=name)
    return Layer(source.spark, path=path, schema=table.schema)


def _replace(source: Layer, zorder_by: Sequence[str], path: str | None, files: int | None) -> Layer:
    spark, name = source.spark, source.name
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    comment = properties.pop("comment", None) or spark.catalog.getTable(name).description
    own = {k: v for k, v in properties.items() if not k.startswith(INTERNAL)}
    suffix = uuid.uuid4().hex
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first().data_type
    # A place of its own, so that taking the name moves no file and no partition.
    path = path or f"{location.rstrip('/')}-{suffix}"
    fresh, old = f"{name}_new_{suffix}", f"{name}_old_{suffix}"
    table = zorder_layout(source.read(), [*partitions, *zorder_by], files)
    write_table(table, name=fresh, path=path, comment=comment, properties=own, written_by=partitions)
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    spark.sql(f"DROP TABLE {old}")
    analyze_table(spark, name, columns=zorder_by)
    return Layer(spark, name=name)
