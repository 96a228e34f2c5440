"""Nearest opponent in every group (a play at an instant), without listing the pairs of a group."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.functions.bits import interleave
from gridpulse.functions.numbers import planar_distance
from gridpulse.operators.groups import BROADCAST_ROWS, Blocks, LargeGroups, ordered_blocks
from gridpulse.session import cut_lineage

# A group with at most this many rows on either side is matched row against array: work per left row that grows with the
# group, so larger groups go to the block search, whose work per row hardly does.
SMALL_GROUP = 128
# Positions in one leaf block, and children of one node, of the search over large groups.
LEAF_SIZE = 16
FANOUT_BITS = 2
# The search starts at a level with at most 2^TOP_BITS nodes on either side.
TOP_BITS = 9
GRID_BITS = 20


def nearest_per_group(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_keys: Sequence[str],
    right_id: str,
    x: str = "x_coord",
    y: str = "y_coord",
    right_name: str | None = None,
    distance_name: str = "separation",
    small_group: int = SMALL_GROUP,
    leaf_size: int = LEAF_SIZE,
) -> DataFrame:
    """For every ``left_keys`` the nearest right row among those equal in all ``on`` columns.

    Result: ``left_keys``, the right row's id as ``right_name`` and the distance. ``left_keys`` must
    contain ``on``; if several left rows share them, the best match of any of them counts. Equal
    distances go to the smallest id. A missing coordinate gives a NULL distance, which ranks last;
    NaN and infinite coordinates count as missing. Left rows without any right row yield nothing.
    """
    on, left_keys = list(on), list(left_keys)
    if not set(on) <= set(left_keys):
        raise ValueError("left_keys must contain the columns of on")
    right_name = right_name or right_id
    known = [F.col(k).isNotNull() for k in on]

    def place(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.when(F.abs(value) < F.lit(float("inf")), value)

    lefts = left.where(_all(known)).select(*left_keys, place(x).alias("_x"), place(y).alias("_y"))
    rights = right.where(_all(known)).select(*on, F.col(right_id).alias("_id"), place(x).alias("_rx"), place(y).alias("_ry"))

    large = _large_groups(lefts, rights, on, small_group)
    small_left, small_right = (lefts, rights) if large is None else (large.outside(lefts), large.outside(rights))
    best = _match_arrays(small_left, small_right, on)
    if large is not None:
        best = best.unionByName(_match_blocks(large.within(lefts), large.within(rights), on, large, leaf_size))
    return (
        best.groupBy(*left_keys)
        .agg(F.min("_best").alias("_best"))
        .select(*left_keys, F.col("_best.id").alias(right_name), F.col("_best.distance").alias(distance_name))
    )


def _all(conditions: Sequence[Column]) -> Column:
    result = F.lit(True)
    for c in conditions:
        result = result & c
    return result


def _candidate(distance: Column, right_id: Column) -> Column:
    """Sort key of a match: known distances first, then by distance, then by id."""
    return F.struct(distance.isNull().alias("unknown"), distance.alias("distance"), right_id.alias("id"))


def _large_groups(lefts: DataFrame, rights: DataFrame, on: list[str], limit: int) -> LargeGroups | None:
    sides = lefts.select(*on, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        rights.select(*on, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counts = sides.groupBy(*on).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    return LargeGroups.find(
        counts.where((F.greatest("l", "r") > limit) & (F.least("l", "r") > 0)), on
    )


def _arrays(lefts: DataFrame, rights: DataFrame, on: list[str]) -> DataFrame:
    """The right rows of every group that has left rows: of others, which may be of any size, none is gathered."""
    met = rights.join(lefts.select(*on).distinct(), on, "left_semi")
    return met.groupBy(*on).agg(F.collect_list(F.struct("_id", "_rx", "_ry")).alias("_others"))


def _match_arrays(lefts: DataFrame, rights: DataFrame, on: list[str]) -> DataFrame:
    """Small groups: the right side becomes one bounded array per group, scanned in place."""
    arrays = _arrays(lefts, rights, on)
    scored = F.transform(
        "_others", lambda r: _candidate(planar_distance(F.col("_x") - r["_rx"], F.col("_y") - r["_ry"]), r["_id"])
    )
    return lefts.join(arrays, on).select(*lefts.columns, F.array_min(scored).alias("_best")).drop("_x", "_y")


# ---------------------------------------------------------------------------------------------
# Large groups. Positions of each side are put in Z-order and cut into blocks of leaf_size; every
# 2^FANOUT_BITS consecutive blocks form a node of the next level. Starting from the few top nodes,
# a left node keeps only those right nodes that may hold the nearest position of one of its own:
# those whose smallest possible distance does not exceed the smallest of the largest possible
# distances. The survivors' children are compared next, down to single left positions and right
# leaf blocks. Bounds are taken from the positions themselves with the distance formula of the
# result, so that rounding never removes a match, ties included. Positions at one distance from all
# left ones, a ring around them, cannot be told apart by bounds: there the candidates approach all pairs.
# ---------------------------------------------------------------------------------------------


def _match_blocks(lefts: DataFrame, rights: DataFrame, on: list[str], large: LargeGroups, leaf_size: int) -> DataFrame:
    has_place = F.col("_x").isNotNull() & F.col("_y").isNotNull()
    lefts = lefts.distinct()
    left_rows = lefts.where(has_place).select(*on, "_x", "_y")
    right_rows = rights.withColumnsRenamed({"_rx": "_x", "_ry": "_y"}).where(has_place)
    left_places = left_rows.distinct()
    right_places = right_rows.groupBy(*on, "_x", "_y").agg(F.min("_id").alias("_id"))
    frame = (
        left_rows.unionAll(right_rows.select(*on, "_x", "_y"))
        .groupBy(*on)
        .agg(
            F.min("_x").alias("_x0"),
            F.min("_y").alias("_y0"),
            F.greatest(F.max("_x") - F.min("_x"), F.max("_y") - F.min("_y")).alias("_side"),
        )
    )
    if large.count <= BROADCAST_ROWS:
        frame = F.broadcast(frame)
    left_blocks = _blocks(left_places, frame, on, leaf_size)
    right_blocks = _blocks(right_places, frame, on, leaf_size)

    levels = max(_levels(left_blocks.span), _levels(right_blocks.span))
    left_leaves = cut_lineage(_boxes(left_blocks.frame, on, F.col("_block"), "a"))
    right_leaves = cut_lineage(_boxes(right_blocks.frame, on, F.col("_block"), "b"))

    pairs = None
    for level in range(levels, -1, -1):
        left_nodes = _raise(left_leaves, on, "a", level)
        right_nodes = _raise(right_leaves, on, "b", level)
        if pairs is None:
            pairs = left_nodes.join(right_nodes, on)
        else:
            kept = pairs.select(*on, F.col("a").alias("_pa"), F.col("b").alias("_pb"))
            pairs = kept.join(left_nodes.withColumn("_pa", F.shiftright("a", FANOUT_BITS)), [*on, "_pa"]).join(
                right_nodes.withColumn("_pb", F.shiftright("b", FANOUT_BITS)), [*on, "_pb"]
            )
        pairs = _prune(pairs, [*on, "a"])

    b_box = ["b", "bx0", "bx1", "by0", "by1"]
    places = left_blocks.frame.select(*on, F.col("_block").alias("a"), "_x", "_y")
    reached = pairs.select(*on, "a", *b_box).join(places, [*on, "a"])
    reached = _prune(
        reached.select(
            *on, "_x", "_y", *b_box,
            *[F.col(c).alias(n) for n, c in (("ax0", "_x"), ("ax1", "_x"), ("ay0", "_y"), ("ay1", "_y"))],
        ),
        [*on, "_x", "_y"],
    )
    others = right_blocks.frame.select(
        *on, F.col("_block").alias("b"), "_id", F.col("_x").alias("_rx"), F.col("_y").alias("_ry")
    )
    found = (
        reached.select(*on, "_x", "_y", "b")
        .join(others, [*on, "b"])
        .groupBy(*on, "_x", "_y")
        .agg(
            F.min(
                _candidate(planar_distance(F.col("_x") - F.col("_rx"), F.col("_y") - F.col("_ry")), F.col("_id"))
            ).alias("_found")
        )
    )
    # Without a usable position on either side the distance is unknown and the smallest id wins.
    unknown = rights.groupBy(*on).agg(F.min(_candidate(F.lit(None).cast("double"), F.col("_id"))).alias("_unknown"))
    if large.count <= BROADCAST_ROWS:
        unknown = F.broadcast(unknown)
    return (
        lefts.join(found, [*on, "_x", "_y"], "left")
        .join(unknown, on)
        .withColumn("_best", F.coalesce("_found", "_unknown"))
        .drop("_x", "_y", "_found", "_unknown")
    )


def _blocks(places: DataFrame, frame: DataFrame, on: list[str], leaf_size: int) -> Blocks:
    top = (1 << GRID_BITS) - 1

    def cell(value: str, origin: str) -> Column:
        share = F.try_divide(F.col(value) - F.col(origin), F.col("_side"))
        return F.coalesce(F.least(F.floor(share * F.lit(float(top))), F.lit(top)), F.lit(0))

    coded = places.join(frame, on).withColumn("_z", interleave([cell("_x", "_x0"), cell("_y", "_y0")], GRID_BITS))
    return ordered_blocks(coded.drop("_x0", "_y0", "_side"), [*on, "_z", "_x", "_y"], leaf_size)


def _levels(span: int) -> int:
    return max(0, ceil((log2(span) - TOP_BITS) / FANOUT_BITS))


def _boxes(blocks: DataFrame, on: list[str], node: Column, side: str) -> DataFrame:
    return blocks.groupBy(*on, node.alias(side)).agg(
        F.min("_x").alias(f"{side}x0"), F.max("_x").alias(f"{side}x1"),
        F.min("_y").alias(f"{side}y0"), F.max("_y").alias(f"{side}y1"),
    )


def _raise(leaves: DataFrame, on: list[str], side: str, level: int) -> DataFrame:
    """Boxes of the nodes ``level`` steps above the leaf blocks."""
    if level == 0:
        return leaves
    return leaves.groupBy(*on, F.shiftright(side, FANOUT_BITS * level).alias(side)).agg(
        *[F.min(f"{side}{d}0").alias(f"{side}{d}0") for d in "xy"],
        *[F.max(f"{side}{d}1").alias(f"{side}{d}1") for d in "xy"],
    )


def _prune(pairs: DataFrame, left_node: list[str]) -> DataFrame:
    """Keeps the right boxes that may hold the nearest position of a place in the left box."""

    def gap(d: str) -> Column:
        return F.greatest(F.lit(0.0), F.col(f"a{d}0") - F.col(f"b{d}1"), F.col(f"b{d}0") - F.col(f"a{d}1"))

    def spread(d: str) -> Column:
        return F.greatest(F.col(f"a{d}1") - F.col(f"b{d}0"), F.col(f"b{d}1") - F.col(f"a{d}0"))

    at_most = F.min(planar_distance(spread("x"), spread("y"))).over(Window.partitionBy(*left_node))
    return (
        pairs.withColumn("_at_least", planar_distance(gap("x"), gap("y")))
        .withColumn("_at_most", at_most)
        .where(F.col("_at_least") <= F.col("_at_most"))
        .drop("_at_least", "_at_most")
    )
