"""Exact k-means over integer vectors, with lower bounds that loosen by geometry.

Components are ``floor(scale * x)``, so sums, means and distances are whole
numbers and the result does not depend on the order of addition.  The first
centroids are the vectors whose id hashes lowest; a round assigns every vector
to its nearest centroid (ties: the smaller number) and moves every non-empty
centroid to the floor of its vectors' mean.

A vector carries an upper bound on the distance to its centroid and a lower
bound on the distance to any other.  After a move, the upper bound grows by its
centroid's drift.  The lower bound need not shrink by the largest drift: the
vectors of a cluster lie in a sphere around the old centroid, whose radius is
their largest upper bound.  For a centroid that moved from a to b, points that
came nearer by d lie inside a branch of a hyperbola with foci a and b, and that
branch inside its asymptotes, a cone about the ray from the middle m through b with
cosine d / |ab|.  In the plane through the sphere's centre and the ray, the
largest cosine over the sphere is that of the angle between the ray and the
centre, less the half-angle under which the sphere is seen from m.  So d is at
most |ab| times that cosine, and nothing if the sphere lies behind m
(:func:`loosening`).  If m is inside the sphere, it is the drift.

Vectors whose bounds do not settle the nearest centroid are compared exactly
with all of them.  Bounds are floating-point numbers with a margin, decisions
between centroids are made on whole numbers only.

A round is one narrow pass that rewrites vectors and bounds to the shared
folder; only sums of ``k`` clusters per task are shuffled, and the driver sees k
rows of ``dims`` numbers.  Neither grows with the data.

Vectors of another length, or with a null or non-finite component, take no part
and are not returned; nor do those with a component of 2 ** 26 or more after scaling,
whose squared distances a long cannot hold.  Null ids take part (they hash as the
empty text); equal ids stay rows, and equal vectors share a cluster.  With fewer
than k vectors each is a centroid of its own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.session import materialized

K, DIMS, ROUNDS, SCALE = 40, 64, 5, 256
SEED = 2
#: Largest component; squared distances of vectors below it fit a long.
LARGEST = 1 << 26
#: Below this component all products and sums of 64 terms are whole numbers that a double holds.
_DOUBLE = 1 << 22
#: Farther than any vector can be.
_FAR = 1e30
#: Relative margin of the bounds, far above rounding errors and far below distances that matter.
MARGIN = 1e-9
#: Rows that one step compares with all centroids.
STEP = 8192


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``(id, v)`` of the vectors that take part."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    fine = (F.size(x) == dims) & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST / scale))
    return (df.where(F.coalesce(fine, F.lit(False)))
            .select(F.col(f"`{id_col}`").alias("id"), F.transform(x, lambda c: F.floor(c * scale).cast("int")).alias("v")))


def first_centroids(vectors: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The k vectors whose ids hash lowest, in that order; equal hashes in the order of id and vector."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.orderBy(key, "id", "v").limit(k).collect()          # k rows, a parameter
    return np.array([r["v"] for r in rows], dtype=np.int64)


def squared_distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, shape (points, centroids)."""
    if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) < _DOUBLE and points.shape[1] <= 64:
        p, c = points.astype(np.float64), centroids.astype(np.float64)
    else:
        # differences keep every number below 2 ** 62
        return np.stack([((points - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    return ((p * p).sum(axis=1)[:, None] - 2.0 * (p @ c.T) + (c * c).sum(axis=1)[None, :]).astype(np.int64)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Per cluster, by how much any other centroid can have come nearer to a vector of it.

    ``old`` and ``new`` are the centroids before and after the move; the vectors of
    cluster i lie within ``radius[i]`` of ``old[i]``.  Never more than the largest drift of the others.
    """
    old, new = old.astype(np.float64), new.astype(np.float64)
    move = new - old
    drift = np.sqrt((move ** 2).sum(axis=1))
    middle = (old + new) / 2
    unit = np.divide(move, drift[:, None], out=np.zeros_like(move), where=drift[:, None] > 0)
    offset = old[:, None, :] - middle[None, :, :]                       # from the middle of j's move to the centre of i
    reach = np.sqrt((offset ** 2).sum(axis=2))
    with np.errstate(divide="ignore", invalid="ignore"):
        angle = np.arccos(np.clip((offset * unit[None]).sum(axis=2) / reach, -1, 1))
        seen = np.arcsin(np.clip(radius[:, None] / reach, 0, 1))        # half-angle of the sphere
    cosine = np.cos(np.clip(angle - seen, 0, np.pi / 2))
    inside = ~(reach > radius[:, None] * (1 + MARGIN))
    nearer = drift[None, :] * np.where(inside, 1.0, np.minimum(1.0, cosine + MARGIN))
    np.fill_diagonal(nearer, 0)
    return nearer.max(axis=1, initial=0.0)


def assign(points: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Brings cluster and bounds up to date in place; returns which vectors were compared with all centroids.

    A vector stays where it is if its upper bound is below its lower bound, or below half the way
    to the nearest other centroid; if not, the upper bound is first made exact.
    """
    c = centroids.astype(np.float64)
    apart = np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2))
    np.fill_diagonal(apart, np.inf)
    half = apart.min(axis=1, initial=np.inf) / 2 * (1 - MARGIN)
    clear = np.maximum(lower, half[cluster])
    open_ = np.flatnonzero(~(upper < clear))
    exact = np.sqrt(((points[open_] - centroids[cluster[open_]]) ** 2).sum(axis=1).astype(np.float64))
    upper[open_] = exact * (1 + MARGIN)
    scanned = open_[~(upper[open_] < clear[open_])]
    for at in range(0, len(scanned), STEP):
        rows = scanned[at:at + STEP]
        d = squared_distances(points[rows], centroids)
        best = d.argmin(axis=1)                                         # the first of equals
        cluster[rows] = best
        upper[rows] = np.sqrt(d[np.arange(len(rows)), best].astype(np.float64)) * (1 + MARGIN)
        d[np.arange(len(rows)), best] = np.iinfo(np.int64).max
        lower[rows] = np.sqrt(d.min(axis=1).astype(np.float64)) * (1 - MARGIN) if len(centroids) > 1 else _FAR
    return scanned


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)


def _passed(state: DataFrame, centroids: np.ndarray, drift: np.ndarray | None, loose: np.ndarray | None) -> DataFrame:
    """One round over vectors and bounds; ``drift`` is None in the first, where every vector is compared."""
    kind = state.select("id", "v").schema.add("cluster", "integer").add("upper", "double").add("lower", "double").add("scans", "integer")
    dims = centroids.shape[1]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("v"), dims)
            n = len(points)
            if drift is None:
                cluster, scans = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32)
                upper, lower = np.full(n, np.inf), np.zeros(n)
            else:
                cluster, scans, upper, lower = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("cluster", "scans", "upper", "lower"))
                upper += drift[cluster]
                upper *= 1 + MARGIN
                lower -= loose[cluster] + MARGIN * (lower + loose[cluster])      # a margin of what is subtracted, not of what is left
            scans[assign(points, cluster, upper, lower, centroids)] += 1
            yield pa.record_batch([batch.column("id"), batch.column("v"), pa.array(cluster), pa.array(upper), pa.array(lower), pa.array(scans)],
                                  names=["id", "v", "cluster", "upper", "lower", "scans"])

    return state.mapInArrow(step, kind)


def _totals(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, list, np.ndarray]:
    """Per cluster: rows, sums of components as whole numbers of any size, and the radius of its sphere."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one row per cluster and task: sums of at most 2 ** 26 times the rows of a task
        n, sums, far = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64), np.zeros(k)
        for batch in batches:
            points, cluster = _matrix(batch.column("v"), dims), batch.column("cluster").to_numpy()
            n += np.bincount(cluster, minlength=k)
            order = np.argsort(cluster, kind="stable")
            here, first = np.unique(cluster[order], return_index=True)
            if len(here):
                sums[here] += np.add.reduceat(points[order], first, axis=0)
            np.maximum.at(far, cluster, batch.column("upper").to_numpy())
        some = np.flatnonzero(n)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64())), pa.array(far[some])],
                              names=["cluster", "n", "sums", "far"])

    parts = state.select("v", "cluster", "upper").mapInArrow(partial, "cluster int, n long, sums array<long>, far double")
    # decimals: the sum over all tasks may pass a long
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("far").alias("far"), F.array(
        *[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(dims)]).alias("sums")).collect()     # k rows
    n, far = np.zeros(k, dtype=np.int64), np.zeros(k)
    sums: list = [[0] * dims for _ in range(k)]
    for r in rows:
        n[r["cluster"]], far[r["cluster"]], sums[r["cluster"]] = r["n"], r["far"], [int(s) for s in r["sums"]]
    return n, sums, far


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS,
            dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid, scans)``.

    ``distance`` is the squared one; ``scans`` says how often the vector was compared with all centroids.
    """
    spark = df.sparkSession
    vectors = materialized(integer_vectors(df, id_col, vector_col, dims, scale))
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return vectors.select("id", *[F.lit(0).cast(t).alias(c) for c, t in (
            ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"))],
            F.col("v").alias("centroid"), F.lit(0).alias("scans"))
    state, drift, loose = vectors, None, None
    for _ in range(rounds):
        state = materialized(_passed(state, centroids, drift, loose))
        n, sums, far = _totals(state, len(centroids), dims)
        moved = np.array([[s // int(n[i]) for s in sums[i]] if n[i] else centroids[i].tolist() for i in range(len(centroids))], dtype=np.int64)
        # empty clusters have no vectors whose bounds could loosen; theirs is an empty sphere
        drift, loose = np.sqrt(((moved - centroids) ** 2).sum(axis=1).astype(np.float64)), loosening(centroids, moved, far)
        centroids = moved
    state = _passed(state, centroids, drift, loose)
    final = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], "cluster int, centroid array<bigint>")
    square = F.aggregate(F.zip_with("v", "centroid", lambda a, b: (a - b) * (a - b)), F.lit(0).cast("bigint"), lambda s, x: s + x)
    found = materialized(state.join(F.broadcast(final), "cluster").select("id", "cluster", square.alias("distance"), "scans"))
    per_cluster = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))       # k rows
    whole = per_cluster.agg(F.sum("cluster_inertia").alias("inertia"))                            # one row
    facts = per_cluster.crossJoin(F.broadcast(whole)).join(F.broadcast(final), "cluster")
    return found.join(F.broadcast(facts), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "scans")


def centroid_digest(centroid: Column) -> Column:
    """Hash of the components as decimal numbers joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda x: x.cast("string")), ",").cast("binary"), 256)
