import numpy as np
import pytest
from pyspark.sql import functions as F

from lagline.llm import hard_negatives
from lagline.llm.queries import QUERIES

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id long, embedding array<double>, label int, tile string, `group` int, windows int"


def slow(rows):
    """Rows (id, vector, label) by comparing everything."""
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or not all(x is not None and abs(x) < np.inf for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        own = (label, [int(np.floor(256 * x)) for x in v])
        kept[i] = min(kept.get(i, own), own)
    out = []
    for a, (label, v) in kept.items():
        if a % 50:
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w, strict=True)), i, other == label)
            for i, (other, w) in kept.items()
            if i != a and len(w) == len(v)
        ]
        scored.sort()
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            good = [s for s in scored if not s[2] and 50 * -p <= 100 * -s[0] <= 95 * -p]
            out += [(a, positive, n + 1, i, -p, -s) for n, (s, i, _) in enumerate(good[:3])]
    return sorted(out)


def mined(frame):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(frame, "vec_id", "embedding", moved, "vec_id % 50 = 0")
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()))


def framed(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, None) for r in rows], SCHEMA)


def made_rows(size=20, count=1500):
    """Clusters with a hot label, repeated vectors, ties and vectors of any length and sign."""
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(5, size))
    rows = []
    for i in range(count):
        v = centres[i % 5] * draw.uniform(0.2, 2) + draw.normal(size=size) * draw.choice([0.1, 1])
        if i % 11 == 0:
            v = centres[0]
        if i % 13 == 0:
            v = np.round(v)
        rows.append((i, [float(x) for x in v], int(i % 3 and draw.integers(10))))
    return rows


@pytest.mark.parametrize("most", [(4096, 8192), (90, 7)])
def test_same_as_comparing_everything(spark, monkeypatch, most):
    monkeypatch.setattr(hard_negatives, "TILE", most[0])
    monkeypatch.setattr(hard_negatives, "PART", most[1])
    rows = made_rows()
    assert mined(framed(spark, rows).repartition(5)) == slow(rows) != []


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [1.0, 1.0], 2), (2, [1.0, 1.5], 2),
        (3, [0.9, 1.0], 1), (4, [1.0, 1.0], 3), (5, [1.0, 1.0], 3), (6, None, 1), (8, [1.0, None], 1),
        (9, [nan, 1.0], 2), (10, [inf, 1.0], 2), (11, [1.0, 1.0], None), (None, [2.0, 1.0], 1),
        (12, [1.0, 1.0, 1.0], 1), (13, [], 1), (50, [], 1), (100, [-1.0, -2.0], 4), (15, [-1.0, 0.0], 4),
        (150, [0.0, 0.0], 6), (16, [0.0, 0.0], 6), (17, [3.0, 0.0], 7),
    ]
    found = mined(framed(spark, rows))
    assert found == slow(rows)
    assert (0, 3, 2, 4, 742, 768) not in found and {r[0] for r in found} >= {0, 150}
    assert mined(framed(spark, rows).limit(0)) == []
    assert mined(framed(spark, [(0, [1.0], 1)])) == []


def test_scores_beyond_64_bits_are_an_error(spark):
    with pytest.raises(ValueError, match="64 bits"):
        mined(framed(spark, [(0, [1e12, 1e12], 1), (1, [1e12, 1.0], 1)]))


def test_index_leaves_out_what_cannot_matter():
    draw = np.random.default_rng(2)
    points = (draw.normal(size=(400, 64)) * np.r_[np.full(8, 300), np.full(56, 4)]).astype(np.int64)
    anchors = points[:20]
    tile = hard_negatives.Tile(np.arange(400), np.zeros(400, np.int64), points)
    scores = anchors @ points.T
    least = np.sort(scores, axis=1)[:, -4].astype(np.float64)
    who, rows = tile.pairs(anchors, least)
    found = set(zip(who.tolist(), rows.tolist(), strict=True))
    assert found >= set(zip(*(x.tolist() for x in np.nonzero(scores >= least[:, None])), strict=True))
    assert len(found) < 400


def test_query_on_the_table(spark):
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    found = sorted(map(tuple, QUERIES["op11_hard_negatives"](spark, folder).select(*COLUMNS).collect()))
    assert found == slow(rows)
