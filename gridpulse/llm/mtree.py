"""Exact top-k inner products by best-first search of an M-tree whose subtrees are spread over the cluster.

Inner products become distances by one more component: with m the largest squared norm, x gets sqrt(m - |x|^2) and a
query gets 0, so the squared distance is |q|^2 + m - 2 q.x. In this metric space

- the root holds at most ``PIVOTS`` pivots, a sample of the rows, with covering radii; every task knows it;
- below a pivot are subtrees of about ``SUBTREE`` rows, so a pivot that has a third of all rows has many subtrees;
- a subtree is cut by distance from the pivot into pages of ``PAGE`` rows. A page stores its routing row, covering
  radius, distance from the pivot, and each row's distance from the routing row.

Queries travel in blocks. A block first visits the pivots with the best bounds, which gives each query a score to beat,
then those other pivots that can still beat it. Within a subtree the stored distances rule out pages and rows before
anything is computed. All bounds allow for rounding and keep ties, so the answer is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import stored

PIVOTS, SUBTREE, PAGE, BLOCK, FIRST_VISITS = 256, 16_384, 256, 256, 4
SCALE = 256
EXACT = 2.0**52  # doubles hold every integer below, and so every product of this size


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """Rows (vec_id, v): floor(scale * component); rows with NULL or non-finite components or NULL vec_id are left out."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    rows = rows.filter("vec_id IS NOT NULL AND x IS NOT NULL").filter(F.forall("x", finite))
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("double")).alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, shorter ones filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _lifted(x: np.ndarray, m: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(m - (x * x).sum(axis=1), 0.0))[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0.0))


def _bytes(*arrays: np.ndarray) -> list[bytes]:
    return [np.ascontiguousarray(x).tobytes() for x in arrays]


def build(rows: DataFrame, pivots: np.ndarray, m: float) -> tuple[DataFrame, list[int]]:
    """The tree below the root: a row for each subtree, with its pages in packed arrays. And each pivot's subtrees."""
    width = pivots.shape[1]
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(_lifted(pivots, m))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distances(_lifted(_matrix(batch.column("v"), width), m), shared.value)
                columns = [batch.column("vec_id"), batch.column("v"), pa.array(d.argmin(axis=1), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "pivot"])

    assigned = stored(rows.mapInArrow(assign, "vec_id long, v array<double>, pivot int"), "mtree-rows")
    sizes = {r["pivot"]: -(-r["count"] // SUBTREE) for r in assigned.groupBy("pivot").count().collect()}
    parts = [sizes.get(p, 1) for p in range(len(pivots))]

    def pages(table: pa.Table) -> pa.Table:
        pivot, part, x = table["pivot"][0].as_py(), table["part"][0].as_py(), _matrix(table["v"], width)
        ids, up = table["vec_id"].to_numpy(), _lifted(x, m)
        to_pivot = _distances(up, shared.value[pivot : pivot + 1])[:, 0]
        order = np.lexsort((ids, to_pivot))
        ids, x, up, to_pivot = ids[order], x[order], up[order], to_pivot[order]
        starts = np.arange(0, len(ids), PAGE)
        routers, radii, to_router = [], [], np.empty(len(ids))
        for s in starts:
            page = up[s : s + PAGE]
            router = s + int(_distances(page, page.mean(axis=0, keepdims=True)).argmin())
            to_router[s : s + PAGE] = _distances(page, up[router : router + 1])[:, 0]
            routers.append(router)
            radii.append(to_router[s : s + PAGE].max())
        packed = _bytes(ids, x, to_router, np.array(routers), np.array(radii), to_pivot[np.array(routers)])
        row = {"pivot": [pivot], "part": [part], "radius": [to_pivot.max()]} | {n: [b] for n, b in zip(FIELDS, packed, strict=True)}
        kinds = [("pivot", pa.int32()), ("part", pa.int64()), ("radius", pa.float64())] + [(n, pa.binary()) for n in FIELDS]
        return pa.table(row, schema=pa.schema(kinds))

    salted = assigned.withColumn("part", F.pmod(F.xxhash64("vec_id"), _of_pivot(parts, "pivot")))
    schema = "pivot int, part long, radius double, " + ", ".join(f"{n} binary" for n in FIELDS)
    return stored(salted.groupBy("pivot", "part").applyInArrow(pages, schema), "mtree"), parts


def _of_pivot(values: list[int], pivot: str) -> Column:
    return F.get(F.array(*[F.lit(v).cast("long") for v in values]), F.col(pivot))


FIELDS = ("ids", "x", "to_router", "routers", "radii", "to_pivot")


def _search(q: np.ndarray, own: np.ndarray, beat: np.ndarray, to_pivot: np.ndarray, tree: dict, m: float, k: int) -> list[tuple]:
    """(query, score, vec_id) of up to ``k`` best rows of one subtree a query, none below the score to ``beat``."""
    width = q.shape[1]
    ids, x = np.frombuffer(tree["ids"], dtype=np.int64), np.frombuffer(tree["x"]).reshape(-1, width)
    routers, radii = np.frombuffer(tree["routers"], dtype=np.int64), np.frombuffer(tree["radii"])
    from_pivot, from_router = np.frombuffer(tree["to_pivot"]), np.frombuffer(tree["to_router"])
    norms, beat = (q * q).sum(axis=1), beat.copy()
    slack = 1e-6 * (1.0 + np.sqrt(m + norms))
    best: list[list] = [[] for _ in q]
    lowest = np.abs(to_pivot[:, None] - from_pivot[None, :]) - radii[None, :]  # of queries from pages, by stored distances
    exact = m < EXACT
    for page in np.argsort(lowest.min(axis=0), kind="stable"):
        reach = np.sqrt(np.maximum(norms + m - 2 * beat, 0.0)) + slack
        alive = np.flatnonzero(lowest[:, page] <= reach)
        if not alive.size:
            continue
        router = x[routers[page] : routers[page] + 1]
        to_router = np.sqrt(np.maximum(norms[alive] + m - 2 * (q[alive] @ router.T)[:, 0], 0.0))
        near = to_router - radii[page] <= reach[alive]
        alive, to_router = alive[near], to_router[near]
        if not alive.size:
            continue
        rows = slice(page * PAGE, min((page + 1) * PAGE, len(ids)))
        possible = np.abs(to_router[:, None] - from_router[None, rows]) <= reach[alive][:, None]
        columns = np.flatnonzero(possible.any(axis=0))
        members = x[rows][columns]
        scores = q[alive] @ members.T if exact else (q[alive].astype(object) @ members.T.astype(object))
        for a, c in zip(*np.nonzero((scores >= beat[alive][:, None]) & possible[:, columns]), strict=True):
            i, vec_id, score = alive[a], int(ids[rows][columns[c]]), int(scores[a, c])
            if vec_id != own[i] and score >= beat[i]:
                best[i].append((-score, vec_id))
                if len(best[i]) >= 4 * k:
                    best[i] = sorted(best[i])[:k]
                    beat[i] = max(beat[i], -best[i][-1][0])
        for i in alive:
            if len(best[i]) >= k:
                best[i] = sorted(best[i])[:k]
                beat[i] = max(beat[i], -best[i][-1][0])
    return [(int(own[i]), -s, v) for i, found in enumerate(best) for s, v in sorted(found)[:k]]


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = SCALE) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` best inner products for each vec_id divisible by ``every``.

    Components are turned into floor(scale * component). Vectors that are NULL, hold NULL or non-finite components or
    have no vec_id take no part; a shorter vector counts as filled with zeros. Ties go to the smaller vec_id. Rows that
    repeat a vec_id are candidates each, never for their own id; as a query only the smallest of them counts.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, scale)
    squared = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    extent = rows.agg(F.max(F.size("v")).alias("width"), F.max(squared).alias("m")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if extent["width"] is None:
        return spark.createDataFrame([], schema)
    width, m = extent["width"], extent["m"]
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(PIVOTS).collect()
    pivots = np.zeros((len(sample), width))
    for i, r in enumerate(sample):
        pivots[i, : len(r["v"])] = r["v"]
    sample_ids = np.array([r["vec_id"] for r in sample])
    tree, parts = build(rows, pivots, m)
    radii = np.full(len(pivots), -1.0)
    for r in tree.groupBy("pivot").agg(F.max("radius").alias("radius")).collect():
        radii[r["pivot"]] = r["radius"]
    root = spark.sparkContext.broadcast((pivots, sample_ids, _lifted(pivots, m), radii))
    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = queries.withColumn("beat", F.lit(float("-inf")))

    def visits(first: bool):
        """Blocks of queries, each sent to the pivots it has to visit: the best few, or the others that can matter."""

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            points, point_ids, lifted, cover = root.value
            for batch in batches:
                for start in range(0, batch.num_rows, BLOCK):
                    block = batch.slice(start, BLOCK)
                    own, q = block.column("vec_id").to_numpy(), _matrix(block.column("v"), width)
                    beat = block.column("beat").to_numpy().copy()
                    norms = (q * q).sum(axis=1)
                    scores = q @ points.T
                    others = np.where(point_ids[None, :] == own[:, None], -np.inf, scores)
                    if others.shape[1] > k:  # the sample's rows are rows too
                        beat = np.maximum(beat, np.partition(others, -k, axis=1)[:, -k])
                    d = np.sqrt(np.maximum(norms[:, None] + m - 2 * scores, 0.0))
                    bound = np.where(cover[None, :] < 0, np.inf, d - cover[None, :])
                    places = np.argsort(np.argsort(bound, axis=1, kind="stable"), axis=1)
                    reach = np.sqrt(np.maximum(norms + m - 2 * beat, 0.0)) + 1e-6 * (1.0 + np.sqrt(m + norms))
                    go = (places < FIRST_VISITS) if first else (places >= FIRST_VISITS) & (bound <= reach[:, None])
                    go &= np.isfinite(bound)
                    for p in np.flatnonzero(go.any(axis=0)):
                        at = go[:, p]
                        packed = _bytes(own[at], q[at], beat[at], d[at, p])
                        columns = [pa.array([p], pa.int32())] + [pa.array([b], pa.binary()) for b in packed]
                        yield pa.RecordBatch.from_arrays(columns, names=["at", "own", "q", "beat", "d"])

        return send

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                own, q = np.frombuffer(r["own"], dtype=np.int64), np.frombuffer(r["q"]).reshape(-1, width)
                found = _search(q, own, np.frombuffer(r["beat"]), np.frombuffer(r["d"]), r, m, k)
                ids, scores, near = zip(*found, strict=True) if found else ((), (), ())
                columns = [pa.array(x, pa.int64()) for x in (ids, near, scores)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    def found(asked: DataFrame, first: bool) -> DataFrame:
        sent = asked.mapInArrow(visits(first), "at int, own binary, q binary, beat binary, d binary")
        # A pivot's subtrees are searched in as many tasks as there are.
        sent = sent.withColumn("in", F.explode(F.sequence(F.lit(0).cast("long"), _of_pivot(parts, "at") - 1)))
        here = (F.col("at") == F.col("pivot")) & (F.col("in") == F.col("part"))
        met = sent.join(tree.drop("radius"), here).drop("at", "pivot", "in", "part")
        return met.mapInArrow(look, "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    early = stored(found(queries, True), "mtree-first")
    ranked = early.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k)
    beat = ranked.select(F.col("query_id").alias("qid"), F.col("score").cast("double").alias("known"))
    asked = queries.join(beat, F.col("vec_id") == F.col("qid"), "left")
    asked = asked.select("vec_id", "v", F.coalesce("known", "beat").alias("beat"))
    every_find = early.unionByName(found(asked, False)).withColumn("rank", F.row_number().over(best))
    return every_find.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
