import zlib

from hard_tables import SMALL, empty, hard  # noqa: F401

from lagline.llm import ring
from lagline.llm.queries import QUERIES


def check_laws(rows, documents, shards):
    sizes = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                   for i, t in documents)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sizes
    by_shard = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(shards)}
    assert sum(map(len, by_shard.values())) == len(rows)
    counts = [len(v) for v in by_shard.values()]
    assert max(counts) - min(counts) <= 1
    assert all(v == list(range(len(v))) for v in by_shard.values())
    assert {(r.law, r.grown_shard) for r in rows} <= {("rows", None)}


def id_and_text(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_hard_texts_and_query(spark, hard):  # noqa: F811
    check_laws(ring.assign(hard, "doc_id", "text", 5).collect(), id_and_text(hard), 5)
    documents = id_and_text(spark.read.parquet(f"{SMALL}/documents.parquet"))
    check_laws(QUERIES["op4_ring_sharding"](spark, SMALL).collect(), documents, 16)


def test_rows_that_are_all_alike(spark):
    rows = [(None, "x")] * 30 + [(1, "x")] * 11
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    check_laws(ring.assign(frame, "doc_id", "text", 4).collect(), rows, 4)


def test_repeated_keys_in_several_pieces(spark):
    """One key of three pieces that spans several shards, among others."""
    rows = [(7, "hot")] * (2 * ring.PIECE + 5) + [(i, f"t{i}") for i in range(500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = ring.assign(frame, "doc_id", "text", 5).collect()
    check_laws(found, rows, 5)
    assert len({r.shard for r in found if r.doc_id == 7}) > 1


def test_few_rows_move_when_a_shard_joins_or_leaves(spark):
    """Full shards leave no slack, so keys pushed on move too, besides the 1,176 rows that a new
    shard must get and the 1,250 that a leaving one must hand over."""
    ids = spark.range(20_000).selectExpr("id as doc_id", "'t' || id as text")
    at = {}
    for shards in (15, 16, 17):
        found = ring.assign(ids, "doc_id", "text", shards).collect()
        at[shards] = {r.doc_id: r.shard for r in found}
    for other in (15, 17):
        moved = sum(at[16][i] != at[other][i] for i in at[16])
        assert 20_000 // 17 <= moved < 2_500


def test_empty_table(empty):  # noqa: F811
    assert ring.assign(empty, "doc_id", "text", 4).collect() == []


def test_keys_stay_in_their_arc_unless_its_shard_is_full(spark):
    """The plan against a walk along the ring, key by key."""
    shards = 6
    points = sorted(tuple(r) for r in ring.arcs(spark, shards, 8).collect())
    assert [p[0] for p in points] == list(range(len(points)))
    wanted = {arc: list(own) for arc, _, own in points}
    assert all(sorted(own) == list(range(shards)) for own in wanted.values())
    demand = {arc: arc * 7 % 13 for arc in wanted}
    total = sum(demand.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    expected = {}
    for arc in wanted:
        for rank in range(demand[arc]):
            shard = next(s for s in wanted[arc] if room[s])
            room[shard] -= 1
            expected[arc, rank] = shard
    table = spark.createDataFrame(list(demand.items()), "arc int, rows long")
    made = ring.plan(table, ring.arcs(spark, shards, 8), shards).collect()
    found = {(r.arc, r.low + k): r.shard for r in made for k in range(r.taken)}
    assert found == expected
    home = sum(s == wanted[arc][0] for (arc, _), s in expected.items())
    assert home / total > 0.5


def test_places_lead_to_the_next_node(spark):
    points = sorted((r.place, r.arc) for r in ring.arcs(spark, 16).collect())
    found = dict(ring.places(ring.arcs(spark, 16)).collect())
    assert len(found) == ring.CELLS
    for place in range(0, ring.CELLS, 97):
        after = [arc for at, arc in points if at >= place]
        assert found[place] == (after[0] if after else 0)
