"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors with a cosine of at least t are at most sqrt(2 - 2 t) apart.  A random rotation, which
keeps distances, spreads that over all dimensions; they are cut into BLOCKS blocks, and in at least
one of them the pair's squared distance is within its share of the budget.  For each block a range
join brings together what can be that near: vectors go to cells of the width of the block's radius by
the block's first coordinate, and cells meet themselves and their next.  In a meeting, the block's
distances prune; what is left is verified by the cosine in double precision.  A pair that
is near in several blocks counts in the first of them only.

Equal vectors are one vector with a weight.  Cells are cut into tiles of bounded size, and tiles
meet in pairs, so no cell outgrows a task; a meeting yields for each vector how many it links and
one link to the least of its group, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfact.llm.components import components
from skyfact.llm.shared import stored

THRESHOLD = 0.9
BLOCKS = 4
TILE_ROWS = 8192
_STRIP = 512
_SLACK = 1e-4


def _rows(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def rotation(dim: int) -> np.ndarray:
    """The same random orthogonal matrix everywhere."""
    return np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))[0]


def block_edges(dim: int, blocks: int = BLOCKS) -> list[tuple[int, int]]:
    cuts = [dim * i // blocks for i in range(blocks + 1)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def block_budgets(dim: int, threshold: float, blocks: int = BLOCKS) -> list[float]:
    """Each block's share of the squared distance, in proportion to its dimensions."""
    return [(2 - 2 * threshold) * (b - a) / dim + _SLACK for a, b in block_edges(dim, blocks)]


def meet(left: np.ndarray, right: np.ndarray | None, left_weight: np.ndarray, right_weight: np.ndarray, block: int, threshold: float, blocks: int = BLOCKS) -> tuple[np.ndarray, np.ndarray]:
    """Linked weight of every vector of left, then right, and the index of the least of its group.

    Without ``right``, left meets itself, each pair once.
    """
    dim = left.shape[1]
    own = right is None
    turn, edges, budgets = rotation(dim), block_edges(dim, blocks), block_budgets(dim, threshold, blocks)
    a, wa = _unit(left), left_weight
    b, wb = (a, wa) if own else (_unit(right), right_weight)
    ra = a @ turn
    rb = ra if own else b @ turn
    lo, hi = edges[block]
    fa, fb = ra[:, lo:hi].astype(np.float32), rb[:, lo:hi].astype(np.float32)
    na, nb = (fa * fa).sum(1), (fb * fb).sum(1)
    n, base = len(a) + (0 if own else len(b)), 0 if own else len(a)
    links, group = np.zeros(n, np.int64), np.arange(n)
    for s in range(0, len(a), _STRIP):
        e = min(len(a), s + _STRIP)
        near = fa[s:e] @ fb.T
        near *= -2
        near += na[s:e, None]
        near += nb
        i, j = np.nonzero(near <= budgets[block] + _SLACK)
        i += s
        if own:
            up = j > i
            i, j = i[up], j[up]
        for p in range(0, len(i), 1 << 17):
            x, y = i[p : p + (1 << 17)], j[p : p + (1 << 17)]
            ok = np.einsum("ij,ij->i", a[x], b[y]) >= threshold
            x, y = x[ok], y[ok]
            first = np.ones(len(x), bool)
            for k in range(block + 1):
                d = ra[x, edges[k][0] : edges[k][1]] - rb[y, edges[k][0] : edges[k][1]]
                within = np.einsum("ij,ij->i", d, d) <= budgets[k]
                first &= within if k == block else ~within
            x, y = x[first], y[first]
            links += np.bincount(x, wb[y], n).astype(np.int64) + np.bincount(y + base, wa[x], n).astype(np.int64)
            _join(group, x, y + base)
    return links, group


def _join(group: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Give linked indices the least index of their groups, until nothing changes."""
    while True:
        gx, gy = group[x], group[y]
        differ = gx != gy
        if not differ.any():
            return
        least = np.minimum(gx[differ], gy[differ])
        np.minimum.at(group, gx[differ], least)
        np.minimum.at(group, gy[differ], least)
        while (group[group] != group).any():
            group[:] = group[group]


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, blocks: int = BLOCKS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(id, vector) -> id, n_links, component_id, kept, one row for each row.

    Vectors that are null, empty or zero, or that hold null or non-finite components, link with
    nothing; vectors of different dimensions don't either.  Repeated rows are vectors of their own and
    link with each other.  A null id gets a row and links, but names no component that has another id.
    """
    kind = vectors.schema["vector"].dataType.elementType.simpleString()
    rows = vectors.select(F.col("id").cast("long").alias("id"), "vector")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    useful = F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0)
    distinct = stored(
        rows.filter(useful).groupBy("vector").agg(F.min("id").alias("least"), F.count("*").alias("weight"))
        .select(F.concat_ws(":", F.coalesce(F.col("least").cast("string"), F.lit("")), F.hex(F.xxhash64("vector"))).alias("node"), "least", "weight", F.size("vector").alias("dim"), "vector"),
        "vectors",
    )

    def place(batches):
        for batch in batches:
            dims = np.asarray(batch["dim"])
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                turned = _unit(_rows(part["vector"], dim)) @ rotation(dim)
                for k, ((lo, _), budget) in enumerate(zip(block_edges(dim, blocks), block_budgets(dim, threshold, blocks))):
                    cell = np.floor(turned[:, lo] / np.sqrt(budget)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([part["dim"], pa.array(np.full(len(cell), k, np.int32)), pa.array(cell), part["node"], part["weight"], part["vector"]], ["dim", "block", "cell", "node", "weight", "vector"])

    shape = f"dim int, block int, cell long, node string, weight long, vector array<{kind}>"
    placed = stored(distinct.mapInArrow(place, shape), "vectors-placed")
    # at most 2 / radius + 2 cells for each block and dimension
    tiles = placed.groupBy("dim", "block", "cell").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles"))
    keys = ["dim", "block", "cell"]
    for name, step in (("own", 0), ("next", 1), ("prior", -1)):
        placed = placed.join(F.broadcast(tiles.withColumn("cell", F.col("cell") - step).withColumnRenamed("tiles", name)), keys, "left")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    tile = F.pmod(F.xxhash64("node"), F.col("own")).cast("int")
    as_ = lambda cell, other, i, j, side: F.struct(cell.alias("cell"), F.lit(other).alias("other"), i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    t = F.col("tile")
    meetings = F.concat(
        F.transform(upto(F.col("own")), lambda j: F.when(j >= t, as_(F.col("cell"), 0, t, j, 0)).otherwise(as_(F.col("cell"), 0, j, t, 1))),
        F.transform(upto(F.col("next")), lambda j: as_(F.col("cell"), 1, t, j, 0)),
        F.transform(upto(F.col("prior")), lambda i: as_(F.col("cell") - 1, 1, i, t, 1)),
    )
    met = placed.withColumn("tile", tile).select("dim", "block", F.explode(meetings).alias("m"), "node", "weight", "vector").select("dim", "block", "m.*", "node", "weight", "vector")

    def compare(key, group):
        dim, block, _, other, i, j = (k.as_py() for k in key)
        side = np.asarray(group["side"])
        order = np.argsort(side, kind="stable")
        group, n = group.take(pa.array(order)), int((side == 0).sum())
        nodes, weight, v = group["node"], np.asarray(group["weight"], np.int64), _rows(group["vector"], dim)
        own = other == 0 and i == j
        if own or 0 < n < len(order):
            links, least = meet(v[:n], None if own else v[n:], weight[:n], weight[n:], block, threshold, blocks)
        else:
            links, least = np.zeros(len(order), np.int64), np.arange(len(order))
        hit = np.flatnonzero(links)
        return pa.table({"node": nodes.take(pa.array(hit)), "links": pa.array(links[hit]), "root": nodes.take(pa.array(least[hit]))})

    found = stored(met.groupBy("dim", "block", "cell", "other", "i", "j").applyInArrow(compare, "node string, links long, root string"), "vector-links")
    groups = components(found.filter("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")), "vector-components")
    links = found.groupBy(F.col("node").alias("_node")).agg(F.sum("links").alias("links"))
    named = distinct.join(links, F.col("node") == F.col("_node"), "left").drop("_node")
    named = named.join(groups.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").withColumn("root", F.coalesce("root", "node"))
    # both sides of the join are tables, so that Spark can split the rows of a large component
    named = stored(named, "vector-roots")
    least = stored(named.groupBy("root").agg(F.min("least").alias("component_id")), "vector-names")
    named = named.join(least, "root").select(F.col("vector").alias("_vector"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = rows.withColumn("_key", F.when(useful, F.col("vector"))).join(named, F.col("_key") == F.col("_vector"), "left")
    component = F.coalesce("component_id", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
