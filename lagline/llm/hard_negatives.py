"""Hard negatives by threshold joins with L2 bounds.

An anchor asks for the best rows in score windows: one window without bounds among the rows of
its own label (its positives), then one window per positive among all other labels. Scores are
inner products of integer vectors, floor(scale * component).

Join. Rows are dealt into tiles of ``TILE`` by their hash (those of one label for positives), the
asking anchors into parts of ``PART``, and each tile meets each part in some task. First all
anchors meet the first tile of their group; a window that it fills raises the window's lower
end, and with these thresholds they meet the other tiles.

In a task the tile is an inverted index: dimensions in the order of their energy, each row under
its first dimensions only. The rest of a row is left out of the index where the norm of that rest
times the largest norm of the anchors' rest cannot reach the threshold. Partial scores add up
dimension by dimension; rows are dropped as soon as the product of the remaining norms cannot
lift them to the threshold of any anchor. Who is left is scored in integers on the whole vectors.
Thresholds start high and are lowered, for anchors whose windows are not yet full, down to the
windows' lower ends.

Null ids, labels and vectors, and vectors with a null or non-finite component take no part. Only
vectors of one length are compared. Of rows with one id, the least by label and vector counts.
Scores that could leave 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagline.llm.common import map_batches, quoted, settled
from lagline.llm.simplex import whole_vectors

TILE = 4096
PART = 8192
#: Dimensions added to the partial scores at a time, and anchors compared with a tile at once.
STEP, SLICE = 16, 128
#: Shares of the way from a window's lower end to the best possible score at which to stop.
LEVELS = (0.7, 0.4, 0.15, 0.0)
LEAST, GREATEST = -(1 << 63), (1 << 63) - 1


class Tile:
    """Rows of a task as an inverted index over dimensions in the order of their energy."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray):
        self.ids, self.labels, self.points = ids, labels, points
        values = points.astype(np.float64)
        self.order = np.argsort(-(values**2).sum(axis=0), kind="stable")
        self.values = values[:, self.order]
        self.cuts = [*range(0, points.shape[1], STEP), points.shape[1]]
        self.rest = rest_norms(self.values, self.cuts)

    def pairs(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, row) places of all pairs that may score at least the anchor's ``least``."""
        values = anchors.astype(np.float64)[:, self.order]
        rest = rest_norms(values, self.cuts)
        slack = 1e-9 * rest[:, :1] * self.rest[:, 0].max() + 1e-6
        # The steps of each row that the index holds: beyond them no anchor's rest matters.
        open_steps = self.rest * rest.max(axis=0)[None] + slack.max() >= least.min()
        steps = np.where(open_steps[:, :-1], np.arange(1, len(self.cuts)), 0).max(axis=1, initial=0)
        live = np.argsort(-steps, kind="stable")
        live = live[steps[live] > 0] if least.min() > slack.max() else live
        held = steps[live]
        score = np.zeros((len(anchors), len(live)))
        for step, (a, b) in enumerate(zip(self.cuts, self.cuts[1:], strict=False)):
            inside = int((held > step).sum())
            if not inside:
                break
            score[:, :inside] += values[:, a:b] @ self.values[live[:inside], a:b].T
            at = np.minimum(held, step + 1)
            bound = score + rest[:, at] * self.rest[live, at][None] + slack
            stay = (bound >= least[:, None]).any(axis=0)
            if not stay.all():
                live, held, score = live[stay], held[stay], score[:, stay]
        bound = score + rest[:, held] * self.rest[live, held][None] + slack
        who, place = np.nonzero(bound >= least[:, None])
        return who, live[place]

    def scores(self, anchors: np.ndarray, who: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.empty(len(who), np.int64)
        for first in range(0, len(who), 1 << 16):
            part = slice(first, first + (1 << 16))
            out[part] = (anchors[who[part]] * self.points[rows[part]]).sum(axis=1)
        return out


def rest_norms(values: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Norms [row, cut] of what comes at or after each cut."""
    return np.stack([np.sqrt((values[:, c:] ** 2).sum(axis=1)) for c in cuts], axis=1)


def fill(
    tile: Tile,
    ids: np.ndarray,
    labels: np.ndarray,
    anchors: np.ndarray,
    windows: list[list[dict]],
    same: bool,
    k: int,
) -> list[tuple]:
    """The k best rows of the tile in each window: (anchor id, window, row id, score)."""
    reach = np.sqrt((anchors.astype(np.float64) ** 2).sum(axis=1)) * tile.rest[:, 0].max() + 1
    low = np.array([min(w["lo"] for w in own) for own in windows], np.float64)
    high = np.array([max(w["hi"] for w in own) for own in windows], np.float64)
    low, high = np.maximum(low, -reach), np.minimum(high, reach)
    left = np.flatnonzero(low <= high)
    out: list[tuple] = []
    for level in LEVELS:
        if not len(left):
            break
        least = low[left] + level * (high[left] - low[left])
        if level == 0:
            least -= 0.5
        who, rows = tile.pairs(anchors[left], least)
        score = tile.scores(anchors[left], who, rows)
        good = (score >= least[who]) & (tile.ids[rows] != ids[left][who])
        good &= (tile.labels[rows] == labels[left][who]) == same
        who, rows, score = who[good], rows[good], score[good]
        order = np.lexsort((tile.ids[rows], -score, who))
        who, rows, score = who[order], rows[order], score[order]
        ends = np.searchsorted(who, np.arange(len(left) + 1))
        still = []
        for i, at in enumerate(left.tolist()):
            own = score[ends[i] : ends[i + 1]]
            own_ids = tile.ids[rows[ends[i] : ends[i + 1]]]
            made, full = [], True
            for window in windows[at]:
                first = int(np.searchsorted(-own, -window["hi"]))
                last = int(np.searchsorted(-own, -window["lo"], side="right"))
                last = min(last, first + k)
                full &= last - first == k or least[i] <= window["lo"]
                made += [
                    (int(ids[at]), window["w"], int(own_ids[j]), int(own[j]))
                    for j in range(first, last)
                ]
            if full or level == 0:
                out += made
            else:
                still.append(at)
        left = np.array(still, np.int64)
    return out


def meet(rows: DataFrame, asks: DataFrame, rest: bool, same: bool, k: int) -> DataFrame:
    """What each anchor finds in the first tile of its group, or in the rest of them.

    ``rows`` has group, tiles, parts, vec_id, label and v; ``asks`` has group, tiles, parts,
    vec_id, label, v and windows. The result has anchor_id, w, vec_id and score.
    """
    own = F.pmod(F.xxhash64("vec_id"), F.col("tiles")).cast("int")
    first = F.col("tile") > 0 if rest else F.col("tile") == 0
    index = rows.withColumn("tile", own).where(first)
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    own = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    tiles = F.sequence(F.lit(1), F.col("tiles") - 1) if rest else F.array(F.lit(0))
    asking = asks.where("tiles > 1") if rest else asks
    asking = asking.withColumn("part", own).withColumn("tile", F.explode(tiles))
    kind = "array<struct<w:int,lo:bigint,hi:bigint>>"
    group = ["group", "tile", "part"]
    columns = [*group, "asks", "vec_id", "label", "v", "windows"]
    index = index.withColumns({"asks": F.lit(0), "windows": F.lit(None).cast(kind)})
    both = index.select(columns).union(asking.withColumn("asks", F.lit(1)).select(columns))
    both = both.repartition(*group).sortWithinPartitions(*group, "asks", "vec_id")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, tile = None, [], None
        for batch in batches:
            names = batch.column("group").to_pylist()
            tiles, parts, asks = (batch.column(c).to_pylist() for c in ("tile", "part", "asks"))
            keys = list(zip(names, tiles, parts, asks, strict=True))
            ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if keys[a][:3] != at:
                    at, held, tile = keys[a][:3], [], None
                flat = batch.column("v").slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
                points = flat.reshape(b - a, len(flat) // (b - a))
                if not keys[a][3]:
                    held.append((ids[a:b], labels[a:b], points))
                    continue
                if not held:
                    continue
                if tile is None:
                    tile = Tile(*map(np.concatenate, zip(*held, strict=True)))
                windows = batch.column("windows").slice(a, b - a).to_pylist()
                for first in range(0, b - a, SLICE):
                    now = slice(first, min(first + SLICE, b - a))
                    made = fill(
                        tile, ids[a:b][now], labels[a:b][now], points[now], windows[now], same, k
                    )
                    if made:
                        columns = list(zip(*made, strict=True))
                        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                            names=["anchor_id", "w", "vec_id", "score"],
                        )

    return map_batches(both, "anchor_id bigint, w int, vec_id bigint, score bigint", find)


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor's window, with their rank from 1."""
    order = Window.partitionBy("anchor_id", "w").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def window_join(
    rows: DataFrame, group: Column, windows: DataFrame, same: bool, k: int
) -> DataFrame:
    """The k best rows in each window: anchor_id, w, vec_id, score, rank.

    ``rows`` has vec_id, label, v; anchors meet those of their ``group``. ``windows`` has
    anchor_id, w, lo, hi: a few rows per anchor. ``same`` asks for rows of the anchor's label,
    otherwise of all others.
    """
    rows = rows.withColumn("group", group)
    named = settled(windows)
    asked = named.select(F.col("anchor_id").alias("vec_id")).distinct()
    asked = rows.join(asked, "vec_id")
    sizes = rows.groupBy("group").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    parts = asked.groupBy("group").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    sizes = settled(sizes.join(parts, "group"))
    index, asked = rows.join(sizes, "group"), settled(asked.join(sizes, "group"))

    def with_windows(table: DataFrame) -> DataFrame:
        own = F.sort_array(F.collect_list(F.struct("w", "lo", "hi"))).alias("windows")
        return asked.join(table.groupBy(F.col("anchor_id").alias("vec_id")).agg(own), "vec_id")

    early = settled(best(meet(index, with_windows(named), False, same, k), k))
    kth = early.where(F.col("rank") == k).select("anchor_id", "w", F.col("score").alias("floor"))
    raised = named.join(kth, ["anchor_id", "w"], "left")
    raised = raised.withColumn("lo", F.greatest("lo", F.coalesce("floor", "lo"))).drop("floor")
    late = meet(index, with_windows(raised), True, same, k)
    return best(early.drop("rank").union(late), k)


def mine(
    vectors: DataFrame,
    id_column: str,
    vector: str,
    label: Column,
    is_anchor: Column | str,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are the rows with ``is_anchor`` (over ``vec_id``). An anchor's positives are the
    best other rows of its label; for each, the best rows of other labels are returned whose
    score is at least ``least`` and at most ``most`` percent of the positive's. Higher scores
    come first, ties by smaller id.
    """
    whole = whole_vectors(vectors, id_column, vector, scale, label=label.cast("bigint"))
    whole = whole.where("vec_id is not null and label is not null")
    once = whole.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("own"))
    rows = settled(once.select("vec_id", "own.label", "own.v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    if (rows.agg(F.max(square)).first()[0] or 0.0) >= 2.0**62:
        raise ValueError("inner products of these vectors can leave 64 bits")
    whole_range = rows.where(is_anchor).select(
        F.col("vec_id").alias("anchor_id"),
        F.lit(0).alias("w"),
        F.lit(LEAST).alias("lo"),
        F.lit(GREATEST).alias("hi"),
    )
    size = F.size("v").cast("string")
    own_label = F.concat_ws(":", size, "label")
    found = window_join(rows, own_label, whole_range, True, positives)
    found = settled(
        found.select(
            "anchor_id",
            (F.col("rank") - 1).alias("w"),
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
    )
    # Ends of a percentage of q * 100 + r, rounded inwards, without leaving 64 bits.
    r = F.pmod("positive_score", F.lit(100))
    q = F.call_function("div", F.col("positive_score") - r, F.lit(100))
    low = q * least + F.call_function("div", r * least + 99, F.lit(100))
    high = q * most + F.call_function("div", r * most, F.lit(100))
    windows = found.select("anchor_id", "w", low.alias("lo"), high.alias("hi")).where("lo <= hi")
    hard = window_join(rows, size, windows, False, negatives)
    return hard.join(found, ["anchor_id", "w"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
