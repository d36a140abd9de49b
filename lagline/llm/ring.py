"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``CELLS`` places. Each shard stands at the hashes of its virtual nodes; the places up
to a node form its arc. Documents stand at the hash of their id, size and text checksum. Shards
hold as many rows as the law ``rows`` allows: counts differ by one at most. The arcs are filled
clockwise; a key whose shard is full goes on to the next shard clockwise with room.

Only counts per place are needed to say which ranks of an arc go to which shard, so this plan is
a table of at most arcs times shards rows, whatever the input; it is made by one aggregate
expression over the arcs. Keys find their ranks by counts before their place and their order
within it. A text is read once and never moved. Slots are gapless per shard.

Null texts have size 1 and the checksum of an empty text. Null and repeated ids are keys like
others. Rows equal in id, size and checksum are interchangeable: they are counted before the
shuffle, the counts are placed, and a count is turned into rows again in pieces of ``PIECE``, so
no task holds all rows of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lagline.llm.common import quoted, settled

CELL_BITS = 16
CELLS = 1 << CELL_BITS
NODES = 64
#: Rows that one piece of a repeated key is turned into.
PIECE = 4096


def arcs(spark: SparkSession, shards: int, nodes: int = NODES) -> DataFrame:
    """One row per virtual node: its place and all shards in the order met clockwise from it."""
    number = spark.range(shards * nodes)
    shard, copy = F.col("id") % shards, F.floor(F.col("id") / shards)
    place = F.shiftrightunsigned(F.xxhash64(shard, copy, F.lit("node")), 64 - CELL_BITS)
    points = number.select(place.alias("place"), shard.cast("int").alias("shard"))
    points = points.groupBy("place").agg(F.min("shard").alias("shard"))
    ring = points.agg(F.array_sort(F.collect_list(F.struct("place", "shard"))).alias("ring"))
    # Two nodes of a shard in one place, or of two shards, leave fewer arcs; all shards are named.
    return ring.select(
        F.posexplode("ring").alias("arc", "point"), F.col("ring.shard").alias("all")
    ).select(
        "arc",
        F.col("point.place").cast("int").alias("place"),
        F.array_distinct(
            F.concat(
                F.expr("slice(all, arc + 1, size(all))"),
                F.expr("slice(all, 1, arc)"),
                F.array(*[F.lit(s) for s in range(shards)]),
            )
        ).alias("wanted"),
    )


def places(ring: DataFrame) -> DataFrame:
    """The arc of each of the fixed number of places: that of the next node clockwise."""
    every = ring.sparkSession.range(CELLS).select(F.col("id").cast("int").alias("place"))
    onward = Window.orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, 0)
    joined = every.join(F.broadcast(ring.select("place", "arc")), "place", "left")
    return joined.select(
        "place", F.coalesce(F.last("arc", ignorenulls=True).over(onward), F.lit(0)).alias("arc")
    )


def plan(demand: DataFrame, ring: DataFrame, shards: int) -> DataFrame:
    """Which ranks of an arc go where: arc, low, taken, shard, slot (of the first)."""
    steps = (
        ring.join(demand, "arc", "left")
        .select("arc", F.coalesce("rows", F.lit(0)).alias("rows"), "wanted")
        .agg(F.array_sort(F.collect_list(F.struct("arc", "rows", "wanted"))).alias("steps"))
    )
    total = "aggregate(steps, 0L, (s, x) -> s + x.rows)"
    room = f"transform(sequence(0, {shards - 1}), s -> div({total}, {shards}L)"
    room += f" + if(s < {total} % {shards}L, 1L, 0L))"
    room = room.replace(f"div({total}, {shards}L)", f"({total} div {shards}L)")
    kept = "array<struct<arc:int,low:bigint,taken:bigint,shard:int,slot:bigint>>"
    state = f"named_struct('free', room, 'out', cast(array() as {kept}))"
    take = "least(a.rest, a.free[s])"
    inner = f"""
      aggregate(x.wanted, named_struct('free', b.free, 'out', b.out, 'rest', x.rows),
        (a, s) -> named_struct(
          'free', transform(a.free, (f, i) -> if(i = s, f - {take}, f)),
          'out', if({take} > 0, concat(a.out, array(named_struct('arc', x.arc,
            'low', x.rows - a.rest, 'taken', {take}, 'shard', s,
            'slot', room[s] - a.free[s]))), a.out),
          'rest', a.rest - {take}),
        a -> named_struct('free', a.free, 'out', a.out))"""
    # One written row, so that the fold finds the room as a value.
    return (
        settled(steps.withColumn("room", F.expr(room)))
        .select(F.expr(f"aggregate(steps, {state}, (b, x) -> {inner})").alias("made"))
        .select(F.inline("made.out"))
    )


def assign(documents: DataFrame, id_column: str, text: str, shards: int) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null)."""
    content = F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))
    rows = documents.select(
        F.col(quoted(id_column)).cast("bigint").alias("doc_id"),
        (F.octet_length(content) + 1).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    rows = rows.withColumn("at", F.xxhash64("doc_id", "size", "text_crc32"))
    rows = rows.withColumn("place", F.shiftrightunsigned("at", 64 - CELL_BITS).cast("int"))
    # One row per key, with the number of equal rows.
    keys = rows.groupBy("place", "at", "doc_id", "size", "text_crc32")
    keys = settled(keys.agg(F.count("*").alias("rows")))

    ring = settled(arcs(documents.sparkSession, shards))
    counts = keys.groupBy("place").agg(F.sum("rows").alias("rows"))
    counts = counts.join(places(ring), "place")
    before = Window.partitionBy("arc").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    counts = settled(counts)
    demand = counts.groupBy("arc").agg(F.sum("rows").alias("rows"))
    # Both tables are bounded: CELLS rows, and arcs times shards rows.
    chosen = F.broadcast(settled(plan(demand, ring, shards)))
    starts = F.broadcast(counts.select("place", "arc", "before"))

    order = Window.partitionBy("place").orderBy("at", "doc_id", "size", "text_crc32")
    order = order.rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("rows").over(order), F.lit(0))
    ranked = keys.withColumn("ahead", ahead).join(starts, "place")
    # A key's ranks are first up to, not including, last.
    ranked = ranked.withColumn("first", F.col("before") + F.col("ahead"))
    ranked = ranked.withColumn("last", F.col("first") + F.col("rows")).drop("rows")
    found = ranked.join(chosen, "arc").where("first < low + taken and last > low")
    found = found.withColumn("first", F.greatest("first", "low"))
    found = found.withColumn("last", F.least("last", F.expr("low + taken")))
    pieces = F.expr(f"explode(sequence(first, last - 1, {PIECE}L))")
    found = found.withColumn("piece", pieces)
    found = found.repartition("at", "piece")
    ranks = F.expr(f"explode(sequence(piece, least(piece + {PIECE}L, last) - 1))")
    return found.withColumn("rank", ranks).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("slot") + F.col("rank") - F.col("low")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
