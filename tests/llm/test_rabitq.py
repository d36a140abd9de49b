import math

import numpy as np
from hard_tables import SMALL

from lagline.llm import rabitq
from lagline.llm.queries import QUERIES

IS_QUERY = "vec_id % 20 = 0"


def slow(rows, k=20):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, own in rows:
        if i % 20 == 0:
            scores = (points * np.array(own, np.float64)).sum(axis=1)
            order = np.lexsort((ids, -scores))
            out[i] = [(int(ids[j]), float(scores[j])) for j in order if ids[j] != i][:k]
    return out


def answers(frame):
    out = {}
    for row in sorted(frame.collect()):
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row.rank == len(out[row.query_id])
    return out


def recall(found, expected):
    hits = sum(len({v for v, _ in found[q]} & {v for v, _ in e}) for q, e in expected.items())
    return hits / sum(map(len, expected.values()))


def test_query_recall(spark):
    rows = [
        (r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    ]
    found, expected = answers(QUERIES["op5_rotated_codes"](spark, SMALL)), slow(rows)
    assert set(found) == set(expected) and recall(found, expected) >= 0.9
    exact = dict(rows)
    for query, own in found.items():
        assert len(own) == 20
        for vec_id, score in own:
            value = math.fsum(a * b for a, b in zip(exact[query], exact[vec_id], strict=True))
            assert abs(score - value) < 1e-12


def made_vectors(size=33, count=2500):
    """Tight groups, loose vectors of any length, and one vector that very many share."""
    draw = np.random.default_rng(11)
    centres = draw.normal(size=(6, size))
    rows = [centres[i % 6] + 0.05 * draw.normal(size=size) for i in range(count // 2)]
    rows += [draw.normal(size=size) * draw.uniform(0.1, 3) for _ in range(count // 5)]
    rows += [rows[0]] * (count - len(rows))
    return [(i, [float(x) for x in v]) for i, v in enumerate(rows)]


def test_recall_with_small_samples_tiles_and_parts(spark, monkeypatch):
    monkeypatch.setattr(rabitq, "SAMPLE_ROWS", 300)
    monkeypatch.setattr(rabitq, "TILE", 200)
    monkeypatch.setattr(rabitq, "PART", 16)
    rows = made_vectors()
    frame = spark.createDataFrame(rows, "id long, v array<double>").repartition(7)
    found, expected = answers(rabitq.search(frame, "id", "v", IS_QUERY)), slow(rows)
    assert set(found) == set(expected) and recall(found, expected) >= 0.97
    # Ties go to the smaller ids.
    assert [v for v, _ in found[0]] == [v for v, _ in expected[0]]


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], "a"), (0, [1.0, 2.0], "a"), (1, [0.5, 1.0], "b"), (2, None, "c"),
        (3, [], "d"), (4, [0.0, 0.0], "e"), (5, [1.0, None], "f"), (6, [nan, 1.0], "g"),
        (7, [inf, 1.0], "h"), (8, [1.0, 2.0, 3.0], "i"), (None, [9.0, 9.0], "j"),
        (20, [-1.0, 1.0], "k"), (9, [3.0, 0.0], "l"), (10, [0.0, 1.5], "m"),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell string")
    found = answers(rabitq.search(frame, "vec_id", "embedding", IS_QUERY))
    assert found == {
        0: [(9, 3.0), (10, 3.0), (1, 2.5), (20, 1.0)],
        20: [(10, 1.5), (0, 1.0), (1, 0.5), (9, -3.0)],
    }
    nothing = rabitq.search(frame.limit(0), "vec_id", "embedding", IS_QUERY)
    assert nothing.collect() == [] and nothing.columns == ["query_id", "rank", "vec_id", "score"]
    assert rabitq.search(frame.where("vec_id = 0"), "vec_id", "embedding", IS_QUERY).collect() == []


def test_estimates_keep_to_their_bounds():
    draw = np.random.default_rng(1)
    points, queries = draw.normal(size=(500, 48)), draw.normal(size=(60, 48))
    turn, centre = rabitq.rotation(48), points[:50].mean(axis=0)
    assert np.allclose(turn @ turn.T, np.eye(48))
    value, off = rabitq.estimates(queries, rabitq.encode(points, centre, turn), centre, turn)
    inside = np.abs(value - queries @ points.T) <= off
    assert inside.mean() > 0.99
