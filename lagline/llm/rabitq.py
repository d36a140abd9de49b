"""Nearest neighbours by inner product with randomly rotated one-bit codes.

Index. Centres of cells are fitted by k-means on at most ``SAMPLE_ROWS`` vectors (smallest hashes
of their ids); every row is then put into the cell of its nearest centre and coded: the residual
to the centre, turned by a fixed random rotation, keeps one sign bit per dimension and two
scalars, its length and its inner product with its own code.

Search. The k-th best score among the sample is a floor for a query. It visits every cell that can
hold a better one: inner product with the centre plus the query's length times the largest
residual. In a cell the inner products with all codes are estimated from packed bits (the query's
rotation cut into bit planes, bits counted word by word). The error bound of an estimate decides
who is reranked: everyone whose upper bound reaches the floor and the k-th best lower bound.
Reranked scores are exact, in double precision on the original vectors, and only they are
returned, as far as they reach the floor.

Cells with more than ``TILE`` rows are split into tiles, and the queries that visit a cell into
parts of ``PART``, so no task holds a large cell. A task holds a tile's rows and takes queries
from a stream.

Vectors that are null, empty, zero, of another length than most, or hold a null or non-finite
component, and rows without an id, take no part. A repeated id counts once with its best score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagline.llm.common import map_batches, quoted, settled, smallest_hashes

SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 64 << 20
MOST_CELLS = 4096
TILE = 4096
PART = 16_384
PLANES = 6
#: Standard errors of an estimate that the bound allows for.
BOUND = 3.0
SEED = 20


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """vec_id and vector (array of doubles) of the rows that take part."""
    values = F.col(quoted(vector)).cast("array<double>")
    rows = vectors.select(F.col(quoted(id_column)).cast("bigint").alias("vec_id"), values.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("vec_id is not null and v is not null and size(v) > 0")
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("n")).count()
    most = lengths.orderBy(F.desc("count"), "n").limit(1).select("n")
    return rows.join(F.broadcast(most), F.size("v") == F.col("n")).drop("n")


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, always the same for a size."""
    draw = np.random.default_rng(SEED).standard_normal((size, size))
    turned, upper = np.linalg.qr(draw)
    return turned * np.sign(np.diag(upper))


def k_means(points: np.ndarray, count: int, rounds: int = 12) -> np.ndarray:
    """Centres, spread out at the start by taking points far from those taken before."""
    draw = np.random.default_rng(SEED)
    centres = [points[0]]
    far = ((points - centres[0]) ** 2).sum(axis=1)
    while len(centres) < count and far.max() > 0:
        chosen = draw.choice(len(points), p=far / far.sum())
        centres.append(points[chosen])
        far = np.minimum(far, ((points - points[chosen]) ** 2).sum(axis=1))
    centres = np.array(centres)
    for _ in range(rounds):
        near = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(axis=1) / 2
    out = np.empty(len(points), np.int64)
    for first in range(0, len(points), 1024):
        part = points[first : first + 1024]
        out[first : first + 1024] = (part @ centres.T - half).argmax(axis=1)
    return out


def encode(points: np.ndarray, centre: np.ndarray, turn: np.ndarray):
    """Packed sign bits [n, words], residual lengths, inner products of residual and code."""
    residual = points - centre
    length = np.sqrt((residual**2).sum(axis=1))
    turned = (residual / np.maximum(length, 1e-300)[:, None]) @ turn
    bits = turned > 0
    fit = np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])
    return packed(bits), length, np.where(length > 0, fit, 1.0)


def packed(bits: np.ndarray) -> np.ndarray:
    words = -(-bits.shape[1] // 64)
    room = np.zeros((len(bits), words * 64), bool)
    room[:, : bits.shape[1]] = bits
    return np.packbits(room, axis=1, bitorder="little").view(np.uint64)


def estimates(queries: np.ndarray, codes, centre: np.ndarray, turn: np.ndarray):
    """Estimated inner products [queries, rows] and how far they may be off."""
    bits, length, fit = codes
    size = queries.shape[1]
    turned = queries @ turn
    low = turned.min(axis=1)
    step = np.maximum(turned.max(axis=1) - low, 1e-300) / ((1 << PLANES) - 1)
    levels = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
    counted = np.zeros((len(queries), len(bits)), np.int64)
    for plane in range(PLANES):
        own = packed(levels >> plane & 1 > 0)
        for word in range(bits.shape[1]):
            both = own[:, word][:, None] & bits[:, word][None]
            counted += np.bitwise_count(both).astype(np.int64) << plane
    ones = np.bitwise_count(bits).sum(axis=1)
    inside = low[:, None] * ones[None] + step[:, None] * counted
    code = (2 * inside - turned.sum(axis=1)[:, None]) / math.sqrt(size)
    norms = np.sqrt((queries**2).sum(axis=1))
    scale = length / fit
    value = (queries @ centre)[:, None] + scale[None] * code
    spread = np.sqrt(np.maximum(1 - fit**2, 0) / max(size - 1, 1))
    off = norms[:, None] * spread[None] + step[:, None]
    return value, BOUND * scale[None] * off


def best(ids, points, codes, centre, turn, query_ids, queries, floors, k: int):
    """The k best reranked rows per query within one tile: query ids, row ids, scores."""
    value, off = estimates(queries, codes, centre, turn)
    value[query_ids[:, None] == ids[None]] = -np.inf
    out_query, out_id, out_score = [], [], []
    lower = value - off
    for i, query in enumerate(query_ids.tolist()):
        cut = floors[i]
        if len(ids) > k:
            cut = max(cut, np.partition(lower[i], len(ids) - k)[len(ids) - k])
        chosen = np.flatnonzero((value[i] + off[i] >= cut) & np.isfinite(value[i]))
        scores = (points[chosen] * queries[i]).sum(axis=1)
        chosen, scores = chosen[scores >= floors[i]], scores[scores >= floors[i]]
        order = np.lexsort((ids[chosen], -scores))[:k]
        out_query += [query] * len(order)
        out_id += ids[chosen][order].tolist()
        out_score += scores[order].tolist()
    return out_query, out_id, out_score


def fit(rows: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres of about a quarter of the square root of ``total`` cells, and the sample that they
    are fitted on: ids and vectors."""
    size = rows.select(F.size("v")).first()[0]
    most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size)))
    chosen = smallest_hashes(rows, "vec_id", most, total).toArrow()
    ids, at = np.unique(chosen.column("vec_id").to_numpy(), return_index=True)
    points = _matrix(chosen.column("v").combine_chunks())[at]
    cells = min(MOST_CELLS, max(1, math.ceil(math.sqrt(total) / 4)), len(points))
    return k_means(points, cells), ids, points


def floor_scores(ids: np.ndarray, points: np.ndarray, known, k: int) -> np.ndarray:
    """Per query the k-th best score among the sample without its own id, a little lowered."""
    sample_ids, sample = known
    out = np.full(len(ids), -np.inf)
    if len(sample_ids) > k:
        for first in range(0, len(ids), 64):
            part = slice(first, first + 64)
            scores = points[part] @ sample.T
            scores[ids[part][:, None] == sample_ids[None]] = -np.inf
            kth = np.partition(scores, len(sample_ids) - k, axis=1)[:, len(sample_ids) - k]
            out[part] = kth - 1e-9 * (1 + np.abs(kth))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def search(
    vectors: DataFrame, id_column: str, vector: str, is_query: Column | str, k: int = 20
) -> DataFrame:
    """query_id, rank, vec_id, score for every usable row with ``is_query`` (over ``vec_id``)."""
    result = "query_id bigint, rank int, vec_id bigint, score double"
    rows = settled(usable(vectors, id_column, vector))
    total = rows.count()
    spark = vectors.sparkSession
    if total == 0:
        return spark.createDataFrame([], result)
    centres, sample_ids, sample = fit(rows, total)
    shared = spark.sparkContext.broadcast((centres, rotation(centres.shape[1])))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value[0]
        for batch in batches:
            points = _matrix(batch.column("v"))
            cell = nearest(points, own)
            away = np.sqrt(((points - own[cell]) ** 2).sum(axis=1))
            batch = batch.append_column("cell", pa.array(cell, pa.int32()))
            yield batch.append_column("away", pa.array(away))

    kept = "vec_id bigint, v array<double>"
    placed = settled(map_batches(rows, f"{kept}, cell int, away double", place))
    reach = np.full(len(centres), -np.inf)
    for row in placed.groupBy("cell").agg(F.max("away").alias("away")).collect():
        reach[row.cell] = row.away * (1 + 1e-9)
    asking = spark.sparkContext.broadcast((reach, (sample_ids, sample)))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (reach, known) = shared.value[0], asking.value
        for batch in batches:
            points, ids = _matrix(batch.column("v")), batch.column("vec_id").to_numpy()
            floors = floor_scores(ids, points, known, k)
            lengths = np.sqrt((points**2).sum(axis=1))
            most = points @ own.T + lengths[:, None] * reach[None]
            wanted = (most >= floors[:, None]) & np.isfinite(reach)[None]
            cells = pa.array([np.flatnonzero(w) for w in wanted], pa.list_(pa.int32()))
            batch = batch.append_column("floor", pa.array(floors))
            yield batch.append_column("cells", cells)

    asked = map_batches(rows.where(is_query), f"{kept}, floor double, cells array<int>", visit)
    asked = settled(asked.select("vec_id", "v", "floor", F.explode("cells").alias("cell")))
    # One row per cell: at most MOST_CELLS.
    sizes = (
        placed.groupBy("cell")
        .agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
        .join(
            asked.groupBy("cell").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")),
            "cell",
        )
    )
    sizes = F.broadcast(settled(sizes))
    own = F.pmod(F.xxhash64("vec_id"), F.col("tiles")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    index = placed.join(sizes, "cell").withColumn("tile", own).withColumn("part", others)
    own = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    queries = asked.join(sizes, "cell").withColumn("part", own).withColumn("tile", others)
    columns = ["cell", "tile", "part", "asks", "vec_id", "v", "floor"]
    both = index.withColumns({"asks": F.lit(0), "floor": F.lit(0.0)}).select(columns)
    both = both.union(queries.withColumn("asks", F.lit(1)).select(columns))
    group = ["cell", "tile", "part"]
    both = both.repartition(*group).sortWithinPartitions(*group, "asks", "vec_id")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, turn = shared.value
        at, held, ready = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in [*group, "asks"]], axis=1)
            ids = batch.column("vec_id").to_numpy()
            points, floors = _matrix(batch.column("v")), batch.column("floor").to_numpy()
            change = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            cuts = [0, *change.tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                key = tuple(keys[a][:3].tolist())
                if key != at:
                    at, held, ready = key, [], None
                if keys[a][3] == 0:
                    held.append((ids[a:b], points[a:b]))
                    continue
                if not held:
                    continue
                if ready is None:
                    own_ids = np.concatenate([h[0] for h in held])
                    own_points = np.concatenate([h[1] for h in held])
                    ready = own_ids, own_points, encode(own_points, centres[key[0]], turn)
                for first in range(a, b, 128):
                    now = slice(first, min(first + 128, b))
                    found = best(
                        *ready, centres[key[0]], turn, ids[now], points[now], floors[now], k
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(found[0], pa.int64()),
                            pa.array(found[1], pa.int64()),
                            pa.array(found[2], pa.float64()),
                        ],
                        ["query_id", "vec_id", "score"],
                    )

    found = map_batches(both, "query_id bigint, vec_id bigint, score double", find)
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
