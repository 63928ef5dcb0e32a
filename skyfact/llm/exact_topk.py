"""Exact top-k search by vector-approximation files.

Every dimension is cut into 2**BITS cells of equal width between its least and largest component.  A
table holds the packed cells of every vector beside the vector itself; only the cells are scanned.  The inner
product of a query with the cells' middles, plus or minus what half a cell can add, bounds the score:

1. a scan of the cells gives each query the k vectors with the best bounds; these are read exactly,
   and the least of their scores is one that the k-th result reaches;
2. a second scan lists the vectors whose upper bound reaches that score.  Only they are read, and the best k
   of them are certain, since nothing else can come up to the score.

Cells and queries meet in blocks of bounded size.  Of equal vectors only the ids that can be among k results
are kept, so a large group of copies does not become candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfact.llm.shared import stored

K = 20
BITS = 5
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
_STRIP = 64
_PAIRS = 1 << 16


def scaled(vector: Column, factor: int = 64) -> Column:
    """floor(factor * x) of every component, as double; null for vectors that take no part."""
    x = F.transform(vector, lambda v: F.floor(v.cast("double") * factor).cast("double"))
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, x)


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def packed(cells: np.ndarray, bits: int) -> list[bytes]:
    """Each row's cell numbers as ``bits`` bits a dimension."""
    each = (cells[:, :, None] >> np.arange(bits, dtype=np.uint8)) & np.uint8(1)
    return [r.tobytes() for r in np.packbits(each.reshape(len(cells), -1), axis=1)]


def unpacked(rows: list[bytes], dim: int, bits: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
    each = np.unpackbits(raw, axis=1, count=dim * bits).reshape(len(rows), dim, bits)
    return (each << np.arange(bits, dtype=np.uint8)).sum(2, dtype=np.uint8)


class Grid:
    """The cells of vectors of one dimension."""

    def __init__(self, low: list[float], high: list[float], bits: int):
        self.low, self.bits = np.array(low), bits
        high = np.array(high)
        self.width = np.maximum(high - self.low, 1e-9) / (1 << bits)
        # half a cell, and room for rounding
        self.slack = 0.5 * self.width * (1 + 1e-6) + 1e-6 * np.maximum(np.abs(self.low), np.abs(high))

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        return np.clip((vectors - self.low) / self.width, 0, (1 << self.bits) - 1).astype(np.uint8)

    def middles(self, rows: list[bytes]) -> np.ndarray:
        return self.low + (unpacked(rows, len(self.low), self.bits) + 0.5) * self.width

    def reach(self, queries: np.ndarray) -> np.ndarray:
        """How far a score can be from that of the middles."""
        return np.abs(queries) @ self.slack


def grids(vectors: DataFrame, bits: int) -> dict[int, Grid]:
    """A grid for each number of dimensions in use; the driver gets two numbers for each of them."""
    ends = vectors.select("dim", F.posexplode("vector").alias("pos", "x")).groupBy("dim", "pos").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    rows: dict[int, list] = {}
    for r in sorted(ends.collect()):
        rows.setdefault(r.dim, []).append(r)
    return {dim: Grid([r.low for r in rs], [r.high for r in rs], bits) for dim, rs in rows.items()}


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, bits: int = BITS, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), id, score: for every query its k best vectors of the same dimension by inner product.

    Both frames have id (long) and vector (array of whole numbers as double, scores within a long); null
    vectors and null ids take no part, neither do empty vectors.  Ties go to the smaller id.  A query does not
    find its own id.  Rows with equal ids count as themselves each, as vectors and as queries: every query row has
    its own k results.  Without vectors the result is empty.
    """
    return _final(*candidates(vectors, queries, k, bits, block_rows, query_rows), k)


def candidates(vectors: DataFrame, queries: DataFrame, k: int = K, bits: int = BITS, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, vectors, queries): the pairs part, query_key, key that are read exactly, and the tables that they name."""
    ready = lambda df: df.select(F.col("id").cast("long").alias("id"), "vector").filter("id IS NOT NULL AND size(vector) > 0").withColumn("dim", F.size("vector"))
    place = lambda n: F.pmod(F.xxhash64("id", "vector", "key"), F.lit(n)).cast("int")
    # k + 1 ids of each vector are enough, since one of them may be the query's own, and k rows of each id
    copies = ready(vectors).withColumn("_n", F.row_number().over(Window.partitionBy("vector", "id").orderBy("dim"))).filter(F.col("_n") <= k)
    useful = copies.withColumn("_n", F.dense_rank().over(Window.partitionBy("vector").orderBy("id"))).filter(F.col("_n") <= k + 1).drop("_n")
    v = stored(useful.withColumn("key", F.monotonically_increasing_id()), "topk-vectors")
    q = stored(ready(queries).withColumn("key", F.monotonically_increasing_id()), "topk-queries")
    n_blocks, n_parts = -(-max(v.count(), 1) // block_rows), -(-max(q.count(), 1) // query_rows)
    grid = grids(v, bits)

    def approximate(batches):
        for batch in batches:
            dims = np.asarray(batch["dim"])
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                cells = packed(grid[dim].cells(_matrix(part["vector"], dim)), bits)
                yield pa.RecordBatch.from_arrays([*(part[c] for c in ("key", "id", "dim", "block")), pa.array(cells, pa.binary()), part["vector"]], ["key", "id", "dim", "block", "cells", "vector"])

    v = stored(v.withColumn("block", place(n_blocks)).mapInArrow(approximate, "key long, id long, dim int, block int, cells binary, vector array<double>"), "topk-cells")
    q = q.withColumn("part", place(n_parts)).select(F.col("key").alias("query_key"), F.col("id").alias("query_id"), "vector", "dim", "part")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cells = v.select("key", "id", "dim", "block", "cells").withColumn("part", every(n_parts))
    place_ = ["block", "part", "dim"]

    def scan(choose, asked: DataFrame) -> DataFrame:
        """What ``choose`` takes of the scores by middles, for each query, as part, query_key, key, about."""

        def run(key, left, right):
            keys, about, owner = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
            _, part, dim = (x.as_py() for x in key)
            if left.num_rows and right.num_rows:
                middles, ids, own = grid[dim].middles(left["cells"].to_pylist()), np.asarray(left["id"]), np.asarray(left["key"])
                ask, ask_ids, ask_keys, need = _matrix(right["vector"], dim), np.asarray(right["query_id"]), np.asarray(right["query_key"]), np.asarray(right["need"], np.float64)
                reach = grid[dim].reach(ask)
                for lo in range(0, len(ask), _STRIP):
                    hi = min(lo + _STRIP, len(ask))
                    rough = ask[lo:hi] @ middles.T
                    rough[ids[None, :] == ask_ids[lo:hi, None]] = -np.inf
                    i, j = choose(rough, need[lo:hi] - reach[lo:hi])
                    keys.append(own[j])
                    about.append(rough[i, j])
                    owner.append(ask_keys[lo + i])
            out = np.concatenate(keys)
            return pa.table({"part": pa.array(np.full(len(out), part, np.int32)), "query_key": np.concatenate(owner), "key": out, "about": np.concatenate(about)})

        shape = "part int, query_key long, key long, about double"
        return cells.groupBy(*place_).cogroup(asked.withColumn("block", every(n_blocks)).groupBy(*place_)).applyInArrow(run, shape)

    def best(rough, _):
        n = min(k, rough.shape[1])
        j = np.argpartition(rough, rough.shape[1] - n, axis=1)[:, rough.shape[1] - n :]
        i = np.repeat(np.arange(len(rough)), n)
        real = np.isfinite(rough[i, j.ravel()])
        return i[real], j.ravel()[real]

    def reaching(rough, least):
        # an own id is at -inf, also where nothing is known of the k-th
        return np.nonzero((rough >= least[:, None]) & (rough > -np.inf))

    order = Window.partitionBy("query_key").orderBy(F.desc("about"), "key")
    first = scan(best, q.withColumn("need", F.lit(float("-inf")))).withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k)
    kth = measured(first, v, q, k).groupBy("query_key").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    kth = stored(kth.filter(F.col("n") >= k).select("query_key", F.col("least").cast("double").alias("need")), "topk-kth")
    asked = q.join(kth, "query_key", "left").withColumn("need", F.coalesce("need", F.lit(float("-inf"))))
    return stored(scan(reaching, asked).drop("about"), "topk-candidates"), v, q


def measured(pairs: DataFrame, vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_key, query_id, id, score of pairs, by the exact vectors; of every block and query the best k."""
    wanted = pairs.groupBy("part", "key").agg(F.collect_list("query_key").alias("wanted"))  # queries of one part at most
    left = stored(wanted.join(vectors.select("key", "id", "dim", "block", "vector"), "key"), "topk-wanted")
    places = left.select(F.col("block").alias("at"), "part", "dim").distinct()
    right = queries.join(places, ["part", "dim"]).select("query_key", "query_id", "vector", *(F.col(c).alias(c) for c in ("at", "part", "dim")))

    def run(key, left, right):
        dim = key[2].as_py()
        v, q = _matrix(left["vector"], dim).astype(np.int64), _matrix(right["vector"], dim).astype(np.int64)
        lists = pa.concat_arrays(left["wanted"].chunks)
        names = np.asarray(right["query_key"])
        order = np.argsort(names)
        i = np.repeat(np.arange(len(v)), np.asarray(lists.value_lengths()))
        j = order[np.searchsorted(names[order], np.asarray(lists.flatten()))]
        score = np.zeros(len(i), np.int64)
        for lo in range(0, len(i), _PAIRS):
            at = slice(lo, lo + _PAIRS)
            score[at] = np.einsum("ij,ij->i", v[i[at]], q[j[at]])
        ids = np.asarray(left["id"])[i]
        by = np.lexsort((ids, -score, j))
        first = np.searchsorted(j[by], j[by])
        by = by[np.arange(len(by)) - first < k]
        return pa.table({"query_key": names[j[by]], "query_id": np.asarray(right["query_id"])[j[by]], "id": ids[by], "score": score[by]})

    def safe(key, left, right):
        if left.num_rows and right.num_rows:
            return run(key, left, right)
        return pa.table({c: pa.array([], pa.int64()) for c in ("query_key", "query_id", "id", "score")})

    return left.groupBy("block", "part", "dim").cogroup(right.groupBy("at", "part", "dim")).applyInArrow(safe, "query_key long, query_id long, id long, score long")


def _final(pairs: DataFrame, vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_key").orderBy(F.desc("score"), "id"))
    return measured(pairs, vectors, queries, k).withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
