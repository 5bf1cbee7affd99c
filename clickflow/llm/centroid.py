"""Centroid clustering of vectors, filtered by PCA-rotated coordinates.

Vectors become integers, so that every distance that decides is exact. One
pass over all vectors gives their covariance; its leading eigenvectors rotate
a vector, and a table keeps the integers, the leading rotated coordinates and
the norm of the rest. In those terms

    |x - c|^2  >=  |lead(x) - lead(c)|^2 + (rest(x) - rest(c))^2,

so most centroids are ruled out by ``leading`` + 1 numbers, and only the
survivors are compared in integers. The bound is lowered by far more than the
rounding of the floats can be, hence no nearest centroid is ever ruled out.

Each round is one job over that table. A task returns sums and counts of its
clusters, which Spark adds up; the driver sees k x (dims + 1) numbers a round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.llm.sqltext import save_shared
from clickflow.session import workers_find_package

LEADING = 16       # rotated coordinates kept
SLACK = 1e-9       # by which a bound is lowered, of the squared norms


def most(dims: int) -> int:
    """The largest size of a component whose distances fit 64 bits."""
    return isqrt((1 << 63) - 1) // (2 * isqrt(dims - 1) + 2) if dims > 1 else 1 << 30


def integers(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of lists of exactly ``dims`` finite numbers, as rows."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.floor(x * scale)
    if len(out) and np.abs(out).max() > most(dims):
        raise ValueError(f"components beyond {most(dims)} / {scale}: distances do not fit 64 bits")
    return out.astype(np.int64).reshape(-1, dims)


@dataclass(frozen=True)
class Rotation:
    """``mean`` and the leading axes, one a column."""
    mean: np.ndarray
    axes: np.ndarray

    def of(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leading coordinates, norm of the rest) of points."""
        x = points - self.mean
        lead = x @ self.axes
        rest = np.maximum((x * x).sum(1) - (lead * lead).sum(1), 0.0)
        return lead, np.sqrt(rest)


def nearest(points: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray,
            rotation: Rotation) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, exact comparisons
    made); among equally near centroids the smaller number."""
    c_lead, c_rest = rotation.of(centroids)
    bound = np.stack([((lead - c_lead[j]) ** 2).sum(1) + (rest - c_rest[j]) ** 2
                      for j in range(len(centroids))], axis=1)
    best = bound.argmin(1)
    diff = points - centroids[best]
    dist = (diff * diff).sum(1)
    x, c = points - rotation.mean, centroids - rotation.mean
    bound -= SLACK * (1 + (x * x).sum(1)[:, None] + (c * c).sum(1))
    alive = bound <= dist[:, None]
    alive[np.arange(len(best)), best] = False
    compared = len(best)
    for j in range(len(centroids)):
        rows = np.flatnonzero(alive[:, j])
        diff = points[rows] - centroids[j]
        d = (diff * diff).sum(1)
        won = (d < dist[rows]) | ((d == dist[rows]) & (j < best[rows]))
        best[rows[won]], dist[rows[won]] = j, d[won]
        compared += len(rows)
    return best, dist, compared


def kept_vectors(vectors: DataFrame, dims: int) -> DataFrame:
    """Rows (vec_id, embedding) with exactly ``dims`` finite components."""
    def finite(x):
        d = x.cast("double")
        return d.isNotNull() & ~F.isnan(d) & (F.abs(d) < float("inf"))
    return vectors.select("vec_id", "embedding").where(
        F.coalesce((F.size("embedding") == dims) & F.forall("embedding", finite), F.lit(False)))


def fit_rotation(kept: DataFrame, dims: int, scale: int, leading: int = LEADING) -> Rotation:
    """The leading axes of all vectors. Tasks return sums of products, one
    row an entry; Spark adds them up and the driver gets dims^2 / 2 numbers."""
    upper = np.triu_indices(dims)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, total, n = np.zeros((dims, dims)), np.zeros(dims), 0
        for b in batches:
            x = integers(b.column(0), dims, scale).astype(np.float64)
            gram += x.T @ x
            total += x.sum(0)
            n += len(x)
        if n:
            rows = np.concatenate([upper[0], np.full(dims + 1, -1)])
            cols = np.concatenate([upper[1], np.arange(-1, dims)])
            values = np.concatenate([gram[upper], [n], total])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), pa.array(cols, pa.int32()), pa.array(values)],
                ["i", "j", "v"])

    found = (kept.select("embedding").mapInArrow(products, "i int, j int, v double")
             .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    v = {(r.i, r.j): r.v for r in found}
    n = max(v.get((-1, -1), 0.0), 1.0)
    mean = np.array([v.get((-1, j), 0.0) for j in range(dims)]) / n
    cov = np.zeros((dims, dims))
    for (i, j), x in v.items():
        if i >= 0:
            cov[i, j] = cov[j, i] = x / n
    _, axes = np.linalg.eigh(cov - np.outer(mean, mean))
    return Rotation(mean, np.ascontiguousarray(axes[:, ::-1][:, :leading]))


def _rotated(kept: DataFrame, rotation: Rotation, dims: int, scale: int) -> DataFrame:
    """vec_id, point (integers), lead, rest."""
    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = integers(b.column(1), dims, scale)
            lead, rest = rotation.of(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), _lists(x), _lists(lead), pa.array(rest)],
                ["vec_id", "point", "lead", "rest"])

    schema = T.StructType([
        kept.schema["vec_id"], T.StructField("point", T.ArrayType(T.LongType())),
        T.StructField("lead", T.ArrayType(T.DoubleType())), T.StructField("rest", T.DoubleType())])
    return kept.mapInArrow(rotate, schema)


def _lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()),
                                    pa.array(rows.ravel()))


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _assigned(stored: DataFrame, centroids: np.ndarray, rotation: Rotation) -> DataFrame:
    """vec_id, cluster, distance."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            best, dist, _ = nearest(_matrix(b.column(1), n), _matrix(b.column(2), n),
                                    b.column(3).to_numpy(), centroids, rotation)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(best, pa.int32()), pa.array(dist)],
                ["vec_id", "cluster", "distance"])

    schema = T.StructType([stored.schema["vec_id"], T.StructField("cluster", T.IntegerType()),
                           T.StructField("distance", T.LongType())])
    return stored.select("vec_id", "point", "lead", "rest").mapInArrow(assign, schema)


def _moved(stored: DataFrame, centroids: np.ndarray, rotation: Rotation) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of what is nearest."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), dtype=np.int64)
        for b in batches:
            n = b.num_rows
            points = _matrix(b.column(0), n)
            best, _, _ = nearest(points, _matrix(b.column(1), n), b.column(2).to_numpy(),
                                 centroids, rotation)
            for j in np.unique(best):
                mine = points[best == j]
                total[j, 0] += len(mine)
                total[j, 1:] += mine.sum(0)
        rows = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(rows, dims + 1), pa.int32()),
             pa.array(np.tile(np.arange(dims + 1), len(rows)), pa.int32()),
             pa.array(total[rows].ravel())], ["cluster", "dim", "total"])

    found = (stored.select("point", "lead", "rest")
             .mapInArrow(sums, "cluster int, dim int, total long")
             .groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
             .collect())
    total = {(r.cluster, r.dim): int(r.total) for r in found}
    out = centroids.copy()
    for (j, d), x in total.items():
        if d:
            out[j, d - 1] = x // total[j, 0]
    return out


def centroid_clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64,
                      scale: int = 1024, seed: str = "3:", leading: int = LEADING) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and the
    final ``centroid`` (integers) of every kept row of ``vectors`` (vec_id,
    embedding).

    Kept are rows of exactly ``dims`` components, none NULL, NaN or infinite; a
    component x becomes floor(scale * x). The k kept rows with the smallest
    sha256 of ``seed`` + vec_id start as centroids 0, 1, ...; rows with equal
    hashes follow their components, a NULL vec_id comes last. Fewer kept rows
    than k make as many centroids, none an empty result. Ties of distance go
    to the smaller number, a centroid without vectors stays where it is.
    Repeated rows count as often as they stand there; other columns are
    ignored. Components whose distances would not fit 64 bits (beyond 10^5 for
    64 dimensions and scale 1024) raise an error.
    """
    spark = vectors.sparkSession
    workers_find_package(spark)
    kept = kept_vectors(vectors, dims)
    first = (kept.withColumn("_h", F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256))
             .orderBy(F.asc_nulls_last("_h"), "embedding").limit(k).collect())
    start = integers(pa.array([r.embedding for r in first], pa.list_(pa.float64())), dims, scale)
    rotation = fit_rotation(kept, dims, scale, leading)
    stored = save_shared(_rotated(kept, rotation, dims, scale), "centroid-points")
    centroids = start
    if len(start):
        for _ in range(rounds):
            centroids = _moved(stored, centroids, rotation)
        assigned = save_shared(_assigned(stored, centroids, rotation), "centroid-assigned")
    else:
        assigned = stored.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    # one row a centroid: k rows, however many vectors there are
    inertia = {r.cluster: int(r.d) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    facts = spark.createDataFrame(
        [(j, d, sum(inertia.values()), centroids[j].tolist()) for j, d in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
