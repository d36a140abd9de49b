"""Clustering around centroids, filtered by n-simplex projection.

Vectors become integers, floor(scale * component), so distances and means are exact. Of the
first centroids a few that span a simplex serve as pivots. Each vector's distances to them are
worked out once and cached as the coordinates of an apex over that simplex: its place in the
pivots' hull, and its height above it. For two apexes the distance in these coordinates is never
more than that of the vectors, and with one height turned over never less. In each round the
centroids get apexes too; a vector is compared in full, in integers, with only the centroids whose
lower bound does not exceed its least upper bound.

Every task hands on one row of sums per centroid; the driver holds the centroids and nothing else.

Null vectors, vectors of another length and those with a null or non-finite component take no
part. Repeated rows count as often as they occur. A row without an id is clustered, but never
starts a centroid. With fewer than ``count`` vectors there are as many centroids; with none the
result is empty. Components so large that squared distances leave 64 bits are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import map_batches, quoted, settled

PIVOTS = 8
#: Rows compared at once.
SLICE = 4096
#: Largest integer component: 2 ** 16 components of twice that, squared, fit in 64 bits.
MOST = 1 << 22
RESULT = (
    "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
    "centroid_sha256 string"
)


def whole_vectors(
    vectors: DataFrame, id_column: str, vector: str, scale: int, **more: Column
) -> DataFrame:
    """vec_id, v (the vector in integers) and further columns of the rows without null or
    non-finite components."""
    rows = vectors.select(
        F.col(quoted(id_column)).cast("bigint").alias("vec_id"),
        F.col(quoted(vector)).cast("array<double>").alias("v"),
        *[column.alias(name) for name, column in more.items()],
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("v").isNotNull() & finite)
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale)))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def squares(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances of all points to a few others, in integers."""
    return np.stack([((points - o) ** 2).sum(axis=1) for o in others], axis=1)


def pivots_of(points: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Up to ``most`` of the points that span a simplex, each far from the hull of the others."""
    chosen = [0]
    away = (points - points[0]).astype(np.float64)
    floor = 1e-6 * max((away**2).sum(axis=1).max(initial=0.0), 1.0)
    while len(chosen) < min(most, len(points)):
        height = (away**2).sum(axis=1)
        far = int(height.argmax())
        if height[far] <= floor:
            break
        chosen.append(far)
        edge = away[far] / np.sqrt(height[far])
        away = away - np.outer(away @ edge, edge)
    return points[chosen]


def simplex(pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the simplex of the pivots: the inverse of its vertex coordinates, and the squared
    distances of the first vertex to the others."""
    edges = (pivots[1:] - pivots[0]).astype(np.float64)
    gram = edges @ edges.T
    corners = np.linalg.cholesky(gram) if len(edges) else gram
    return np.linalg.inv(corners) if len(edges) else corners, np.diag(gram)


def apexes(distances: np.ndarray, base: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Coordinates from squared distances to the pivots; the last is the height."""
    inverse, lengths = base
    first = distances[:, :1].astype(np.float64)
    inside = (first + lengths[None] - distances[:, 1:]) / 2 @ inverse.T
    height = np.maximum(first[:, 0] - (inside**2).sum(axis=1), 0.0)
    return np.concatenate((inside, np.sqrt(height)[:, None]), axis=1)


def bounds(own: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds [own, others] of squared distances, with room for rounding."""
    lower = np.stack([((own - o) ** 2).sum(axis=1) for o in others], axis=1)
    upper = lower + 4 * own[:, -1:] * others[None, :, -1]
    room = 1e-7 * (1 + (own**2).sum(axis=1)[:, None] + (others**2).sum(axis=1)[None])
    return lower - room, upper + room


def nearest(
    points: np.ndarray, own: np.ndarray, centroids: np.ndarray, others: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each point's nearest centroid; ties go to the smaller
    number. ``own`` and ``others`` are the apexes of the points and of the centroids."""
    lower, upper = bounds(own, others)
    open_pairs = lower <= upper.min(axis=1)[:, None]
    exact = np.full(open_pairs.shape, np.iinfo(np.int64).max)
    for j, centroid in enumerate(centroids):
        rows = np.flatnonzero(open_pairs[:, j])
        exact[rows, j] = ((points[rows] - centroid) ** 2).sum(axis=1)
    best = exact.argmin(axis=1)
    return best, exact[np.arange(len(points)), best]


def cluster(
    vectors: DataFrame,
    id_column: str,
    vector: str,
    size: int = 64,
    scale: int = 64,
    count: int = 16,
    rounds: int = 3,
) -> DataFrame:
    """Per vector of ``size`` components: vec_id, cluster, distance (squared), cluster_inertia,
    inertia and the SHA-256 of its centroid, after ``rounds`` rounds and a last assignment.

    The centroids start as the vectors whose ids have the smallest hashes.
    """
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, id_column, vector, scale).where(F.size("v") == size)
    mark = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    named = rows.where("vec_id is not null").select(mark.alias("mark"), "v")
    starts = named.orderBy("mark", "v").limit(count).collect()
    if not starts:
        return spark.createDataFrame([], RESULT)
    centroids = np.array([r.v for r in starts], np.int64).reshape(len(starts), size)
    pivots = pivots_of(centroids)
    base = simplex(pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for first in range(0, batch.num_rows, SLICE):
                points = matrix(batch.slice(first, SLICE).column("v"), size)
                if np.abs(points).max(initial=0) > MOST:
                    raise ValueError(f"an integer component is over {MOST}")
                made += list(apexes(squares(points, pivots), base))
            yield batch.append_column("apex", pa.array(made, pa.list_(pa.float64())))

    placed = settled(map_batches(rows, "vec_id bigint, v array<bigint>, apex array<double>", place))

    def slices(batch: pa.RecordBatch, now: np.ndarray, others: np.ndarray) -> Iterator[tuple]:
        for first in range(0, batch.num_rows, SLICE):
            part = batch.slice(first, SLICE)
            points = matrix(part.column("v"), size)
            own = matrix(part.column("apex"), len(pivots))
            yield part, points, *nearest(points, own, now, others)

    def sums(now: np.ndarray) -> DataFrame:
        others = apexes(squares(now, pivots), base)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals, counts = np.zeros(now.shape, np.int64), np.zeros(len(now), np.int64)
            for batch in batches:
                for _, points, best, _ in slices(batch, now, others):
                    np.add.at(totals, best, points)
                    counts += np.bincount(best, minlength=len(now))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(now)), pa.int32()),
                    pa.array(counts),
                    pa.array(list(totals), pa.list_(pa.int64())),
                ],
                names=["cluster", "n", "totals"],
            )

        schema = "cluster int, n bigint, totals array<bigint>"
        cells = map_batches(placed.select("v", "apex"), schema, work)
        cells = cells.select("cluster", "n", F.posexplode("totals").alias("at", "total"))
        return cells.groupBy("cluster", "at").agg(
            F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
        )

    for _ in range(rounds):
        moved = centroids.copy()
        for cell in sums(centroids).collect():  # one row per centroid and component
            if cell.n:
                moved[cell.cluster, cell.at] = int(cell.total) // cell.n
        centroids = moved
    others = apexes(squares(centroids, pivots), base)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, best, distance in slices(batch, centroids, others):
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(best, pa.int32()), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"],
                )

    found = settled(map_batches(placed, "vec_id bigint, cluster int, distance bigint", assign))
    inertia = found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("cluster_inertia")
    )
    own = {r.cluster: int(r.cluster_inertia) for r in inertia.collect()}  # one row per centroid
    lines = [",".join(map(str, c)).encode() for c in centroids.tolist()]
    ends = spark.createDataFrame(
        [(i, n, sum(own.values()), hashlib.sha256(lines[i]).hexdigest()) for i, n in own.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return found.join(F.broadcast(ends), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
