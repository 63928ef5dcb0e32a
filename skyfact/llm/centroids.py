"""Centroid clustering with geometric drift tightening, exact in integers.

Every vector keeps an upper bound of the distance to its centroid and a lower bound of the distance to
any other.  When centroids have moved, the upper bound grows by the way of its own.  A lower bound
would have to shrink by the longest way of another; but how much nearer a centroid comes to a vector depends
on where the vector is, and it is known to be in the sphere around its own centroid that holds the whole
cluster.  In the plane through the sphere's centre and both places of the moved centroid the sphere is a disc;
seen from a point of the way, no vector of the disc is nearer to the way's direction than the tangent to the
disc, so the step there gains at most that angle's cosine.  Summed over the way, that bounds the gain,
which is often a small part of the way and not seldom nothing.

Vectors whose bounds leave no doubt stay where they are; for the others the distance to the own centroid
is measured, and if doubt remains, those to all centroids, in integers.  Ties go to the smaller number.

Vectors are never shuffled.  A pass writes vectors with cluster and bounds; Spark sums those that have changed
their cluster, by cluster, and the driver gets one row for each cluster.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfact.llm.shared import in_batches, stored

CLUSTERS, ROUNDS, SCALE, SEED = 16, 3, 64, 1
#: Components reach this far either way, so that squared distances of 64 components fit a long; what is beyond counts as this.
FARTHEST = 1 << 27
#: Points of a centroid's way at which the gain is bounded; more points make the bound tighter.
STEPS = 32
#: Bounds are floating-point numbers; they are widened by this share and this much.
_RELATIVE, _ABSOLUTE = 1e-9, 1e-6


def whole(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, as double, within FARTHEST."""
    within = lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(FARTHEST)), F.lit(-FARTHEST))
    return F.transform(vector, lambda x: within(x).cast("int"))


def usable(vector: Column, dim: int) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) == dim) & ~bad


def first_centroids(vectors: DataFrame, n: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the least digests of seed and id; of equal ids the lesser vector first, null ids last."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(draw.asc_nulls_last(), "vector").select("vector").limit(n).collect()
    return np.array([r.vector for r in rows], np.int64)


def squared(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of every vector to every centroid."""
    out = np.empty((len(v), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        d = v - c
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return out


def _above(x: np.ndarray) -> np.ndarray:
    return x * (1 + _RELATIVE) + _ABSOLUTE


def _below(x: np.ndarray) -> np.ndarray:
    return x * (1 - _RELATIVE) - _ABSOLUTE


def gain(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray, steps: int = STEPS) -> float:
    """How much nearer, at most, a centroid that goes from old to new comes to any point of the sphere."""
    way = new.astype(float) - old
    length = float(np.sqrt(way @ way))
    if length == 0:
        return 0.0
    out = centre.astype(float) - old
    along = float(out @ way) / length
    across = float(np.sqrt(max(out @ out - along * along, 0.0)))
    # the most that a step gains falls along the way, so its value at the start bounds each piece of it
    at = along - np.arange(steps) * (length / steps)
    distance = np.hypot(at, across)
    angle = np.arctan2(across, at)
    tangent = np.where(distance > radius, np.arcsin(np.minimum(radius / np.maximum(distance, 1e-300), 1.0)), np.pi)
    most = np.cos(np.clip(angle - tangent - 1e-7, 0.0, np.pi))
    return float(_above(max(0.0, most.sum() * (length / steps))))


def loosening(old: np.ndarray, new: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(how much upper bounds grow, how much lower bounds shrink), by cluster."""
    n = len(old)
    drift = _above(np.sqrt(((new - old).astype(float) ** 2).sum(1)))
    shrink = np.zeros(n)
    for i in range(n):
        # other centroids that stayed gain nothing, and none gains more than its way
        gains = [min(drift[j], gain(old[i], radii[i], old[j], new[j])) for j in range(n) if j != i and (old[j] != new[j]).any()]
        shrink[i] = max(gains, default=0.0)
    return drift, shrink


def assigned(v: np.ndarray, centroids: np.ndarray, state: tuple | None, moves: tuple | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, upper, lower, how the row was settled: 0 by bounds, 1 by its own distance, 2 by all)."""
    n = len(v)
    if state is None:
        cluster, upper, lower = np.zeros(n, np.int32), np.full(n, np.inf), np.full(n, -np.inf)
    else:
        cluster, upper, lower = (x.copy() for x in state)
        grow, shrink = moves
        upper, lower = _above(upper + grow[cluster]), _below(lower - shrink[cluster])
    settled = np.zeros(n, np.int8)
    open_ = np.flatnonzero(upper >= lower)
    if state is not None and len(open_):
        d = v[open_] - centroids[cluster[open_]]
        upper[open_] = _above(np.sqrt(np.einsum("ij,ij->i", d, d).astype(float)))
        settled[open_] = 1
        open_ = open_[upper[open_] >= lower[open_]]
    if len(open_):
        settled[open_] = 2
        all_ = squared(v[open_], centroids)
        best = all_.argmin(1)
        at = np.arange(len(open_))
        nearest = all_[at, best].copy()
        all_[at, best] = np.iinfo(np.int64).max
        cluster[open_], upper[open_], lower[open_] = best, _above(np.sqrt(nearest.astype(float))), _below(np.sqrt(all_.min(1).astype(float)))
    return cluster, upper, lower, settled


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, dim)


def _pass(table: DataFrame, centroids: np.ndarray, moves: tuple | None, dim: int) -> DataFrame:
    """Every vector with its cluster, the one before, bounds, and how it was settled."""
    first = moves is None

    def run(batches):
        for batch in batches:
            v = _matrix(batch["vector"], dim)
            state = None if first else tuple(np.asarray(batch[c]) for c in ("cluster", "upper", "lower"))
            cluster, upper, lower, settled = assigned(v, centroids, state, moves)
            before = np.full(len(v), -1, np.int32) if first else state[0]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["vector"], *map(pa.array, (cluster, before, upper, lower, settled))],
                ["id", "vector", "cluster", "before", "upper", "lower", "settled"],
            )

    shape = "id long, vector array<int>, cluster int, before int, upper double, lower double, settled byte"
    return in_batches(table).mapInArrow(run, shape)


def _moved(table: DataFrame, dim: int) -> list:
    """By cluster: sums of what has come and gone, as decimals, and how many rows."""
    changed = table.filter("cluster <> before")
    both = F.array(F.struct(F.col("cluster").alias("no"), F.lit(1).alias("sign")), F.struct(F.col("before").alias("no"), F.lit(-1).alias("sign")))
    rows = changed.select("vector", F.inline(both)).filter("no >= 0").withColumn("part", F.spark_partition_id())
    # the sums of a partition fit a long; those of all partitions are decimals
    sums = rows.groupBy("no", "part").agg(F.sum("sign").alias("n"), *[F.sum(F.col("vector")[i] * F.col("sign")).alias(f"s{i}") for i in range(dim)])
    return sums.groupBy("no").agg(F.sum("n").alias("n"), *[F.sum(F.col(f"s{i}").cast("decimal(20,0)")).alias(f"s{i}") for i in range(dim)]).collect()


def clustered(vectors: DataFrame, n: int = CLUSTERS, rounds: int = ROUNDS, dim: int = 64, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray, list[DataFrame]]:
    """(id, vector) -> (id, vector, cluster, upper, lower, ... of the last assignment; final centroids; the assignments of all rounds).

    Vectors that are null, have another number of components, or hold null or non-finite ones take no
    part.  Equal rows are vectors of their own.  With fewer vectors than centroids, each is one; without
    vectors, the result is empty.  A centroid whose cluster is empty stays where it is.
    """
    rows = vectors.select(F.col("id").cast("long").alias("id"), "vector").filter(usable(F.col("vector"), dim))
    table = stored(rows.withColumn("vector", whole(F.col("vector"), scale)), "centroids-vectors")
    centroids = first_centroids(table, n, seed)
    if not len(centroids):
        return _pass(table, np.zeros((1, dim), np.int64), None, dim), centroids, []
    sums, counts = [[0] * dim for _ in centroids], [0] * len(centroids)
    moves, passes = None, []
    for left in range(rounds, -1, -1):
        table = stored(_pass(table, centroids, moves, dim), "centroids-pass")
        passes.append(table)
        if not left:
            return table, centroids, passes
        for r in _moved(table, dim):
            counts[r.no] += r.n
            sums[r.no] = [a + int(r[f"s{i}"]) for i, a in enumerate(sums[r.no])]
        new = np.array([[s // c for s in row] if c else old.tolist() for row, c, old in zip(sums, counts, centroids)], np.int64)
        radii = np.zeros(len(centroids))
        for r in table.groupBy("cluster").agg(F.max("upper").alias("radius")).collect():
            radii[r.cluster] = r.radius
        moves, centroids = loosening(centroids, new, radii), new


def measured(table: DataFrame, centroids: np.ndarray, dim: int = 64) -> DataFrame:
    """id, cluster, distance (squared) of an assignment."""

    def run(batches):
        for batch in batches:
            cluster = np.asarray(batch["cluster"])
            d = _matrix(batch["vector"], dim) - (centroids[cluster] if len(centroids) else 0)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["cluster"], pa.array(np.einsum("ij,ij->i", d, d))], ["id", "cluster", "distance"])

    return in_batches(table.select("id", "vector", "cluster")).mapInArrow(run, "id long, cluster int, distance long")


def clusters(vectors: DataFrame, n: int = CLUSTERS, rounds: int = ROUNDS, dim: int = 64, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """(id, vector) -> id, cluster, distance, cluster_inertia, inertia, centroid, a row for each vector that takes part.

    As ``clustered``.  Sums of distances that no long holds are null.
    """
    table, centroids, _ = clustered(vectors, n, rounds, dim, scale, seed)
    out = stored(measured(table, centroids, dim), "centroids-distances")
    # one row for each cluster
    sums = out.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia")).collect()
    known = [r.cluster_inertia for r in sums]
    total = sum(known) if None not in known else None
    total = total if total is not None and total < 1 << 63 else None
    named = [(r.cluster, r.cluster_inertia, total, centroids[r.cluster].tolist()) for r in sums]
    names = table.sparkSession.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return out.join(F.broadcast(names), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest(centroid: list[int]) -> str:
    """Of the components as decimal integers, joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
