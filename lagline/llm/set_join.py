"""Documents whose sets of word shingles are alike, by a metric-space join, exactly.

The Jaccard distance is a metric. Two sets within ``reach`` of each other are linked; a document's
component is what its links reach.

Root regions. Unrelated texts are all at distance 1, where no text is of use as a pivot, so the
first pivots are single shingles. A set lacks at most a fifth of a partner's shingles (at the
usual 0.8), so partners meet in a shingle within a prefix of either set, in any order of all
shingles. Documents that cannot have a partner go first: those with too few shared ones among
their smallest hashes (``front``), then those with too few shared ones at all. The rest are
joined to the regions of the rarest shingles of their prefixes, and regions with a document in
common are one. No pair of partners is in two of them.

Regions. A region that one task cannot hold is cut by ``PIVOTS`` of its documents. Each document
belongs to the Voronoi cell of its nearest pivot, and is repeated in the cells of other pivots
as far as the triangle inequality lets a partner be there; what is far from all pivots makes a
cell of its own. A document linked to the pivot is left out where nobody near the pivot's ball
could be its partner. Cells are cut again while they are too large. A region whose cells hold
together about as many pairs as it has itself (a family of edits of one text is in all cells) is
not cut: it is dealt out once to tiles that any two documents share. What fits in a task is
joined there by the same recursion, down to leaves where all sets are compared at once, by
products of 0/1 rows.

Equal sets are one set. Only links that join a component are handed on, at most one per document
and cell. Words are runs of bytes between blanks, A-Z in lower case; a text of fewer words than a
shingle is one shingle. Shingles are compared by 64-bit hashes. A null text, or one without words,
has no shingles and no links. A null id is never a component's id, unless it has no other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagline.llm.common import content_key, map_batches, map_texts, quoted, settled
from lagline.llm.components import components
from lagline.llm.grams import WordCodes, run_hashes, word_codes

#: Most documents, and shingles, of a region that one task joins.
MOST_ROWS, MOST_SHINGLES = 2048, 1 << 21
#: Pivots of a region, and documents of a leaf.
PIVOTS, LEAF = 16, 32
#: A document belongs to no pivot's cell that is farther away, but to the far cell.
FAR = 0.6
#: Cells with more pairs in all than a cell of this share of the region have not become smaller.
SMALLER = 0.8
#: A member of at least this share of the sets is counted by products, whose blocks have so many
#: numbers.
COMMON, BLOCK = 1 / 16, 1 << 22
ROUNDING = 1e-9
LAST = (1 << 63) - 1
FAR_CELL = -1


def shingle_set(text: str | None, size: int, known: WordCodes) -> np.ndarray:
    """The distinct shingles' hashes in order, as signed longs."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.int64)
    hashes = run_hashes(word_codes(words, known), min(size, len(words)))
    if len(words) < size:
        hashes = hashes ^ np.uint64(len(words))
    return np.unique(hashes.view(np.int64))


def lacking(size: int, percent: int) -> int:
    """Most shingles of a set of ``size`` that a partner may lack."""
    return size - (size * percent + 99) // 100


def asked(size: int) -> int:
    """Shared shingles that partners have at least within the fronts of sets of that size."""
    return max(1, size // 20)


def front(hashes: np.ndarray, percent: int) -> np.ndarray:
    """The smallest hashes: in two partners' fronts the first ``asked`` of their common ones
    (of the smaller set) have no room to be missing."""
    size = len(hashes)
    return hashes[: lacking(size, percent) + asked(size)] if size else hashes


def surveyed(
    documents: DataFrame, id_column: str, text: str, shingle: int, percent: int
) -> DataFrame:
    """Written once: doc_id, at (the id in order, null last), content (of the text), key (of the
    set, null if empty), n_shingles and front."""

    def start() -> Callable[[list], list]:
        known = WordCodes()

        def work(texts: list) -> list:
            sets = [shingle_set(t, shingle, known) for t in texts]
            keys = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
            return [keys, list(map(len, sets)), [front(s, percent) for s in sets]]

        return work

    ids, content = F.col(quoted(id_column)).cast("bigint"), F.col(quoted(text))
    rows = documents.select(
        ids.alias("doc_id"),
        F.coalesce(ids, F.lit(LAST)).alias("at"),
        content_key(content).alias("content"),
        content.alias("text"),
    )
    fields = [
        ("key", "binary", pa.binary()),
        ("n_shingles", "bigint", pa.int64()),
        ("front", "array<bigint>", pa.list_(pa.int64())),
    ]
    return settled(map_texts(rows, "text", fields, start))


def shared(sets: DataFrame, hashes: str, distinct: bool = False) -> DataFrame:
    """cell (class), shingle and n (rows that have it), of the shingles that several classes
    have; ``distinct`` if no class has several rows, so that counting them tells."""
    every = sets.select("cell", F.explode(hashes).alias("shingle"))
    common = every.groupBy("shingle").agg(
        F.count("*").alias("n"),
        *([] if distinct else [F.min("cell").alias("low"), F.max("cell").alias("high")]),
    )
    common = common.where("n > 1" if distinct else "low < high").select("shingle", "n")
    return every.join(common, "shingle")


def candidates(survey: DataFrame, percent: int) -> DataFrame:
    """Written once: one row per set that passes the first test, with the document that has
    it: key, n, at, content. Copies count their shared shingles as often as they are."""
    rows = survey.where("key is not null")
    sets = rows.groupBy("key").agg(
        F.min(F.struct("at", "content")).alias("owner"),
        F.first("n_shingles").alias("n"),
        F.count("*").alias("copies"),
    )
    fronts = rows.select(F.xxhash64("key").alias("cell"), "front")
    counts = shared(fronts, "front").groupBy("cell").agg(F.count("*").alias("met"))
    least = F.call_function("div", F.col("n") * percent + 99, F.lit(100))
    least = F.greatest(F.lit(1), F.call_function("div", least, F.lit(20)))
    chosen = sets.withColumn("cell", F.xxhash64("key")).join(counts, "cell")
    chosen = chosen.where(F.col("met") >= least * F.col("copies"))
    return settled(chosen.select("key", "n", "owner.at", "owner.content"))


def with_sets(
    documents: DataFrame, id_column: str, text: str, chosen: DataFrame, shingle: int
) -> DataFrame:
    """Written once: cell, key, n and hashes (the whole set) of the chosen sets."""

    def start() -> Callable[[list], list]:
        known = WordCodes()
        return lambda texts: [[shingle_set(t, shingle, known) for t in texts]]

    content = F.col(quoted(text))
    rows = documents.select(
        F.coalesce(F.col(quoted(id_column)).cast("bigint"), F.lit(LAST)).alias("at"),
        content_key(content).alias("content"),
        content.alias("text"),
    )
    rows = rows.join(chosen, ["content", "at"]).drop("content", "at").dropDuplicates(["key"])
    hashes = [("hashes", "array<bigint>", pa.list_(pa.int64()))]
    return settled(map_texts(rows, "text", hashes, start).withColumn("cell", F.xxhash64("key")))


def root_regions(sets: DataFrame, percent: int) -> DataFrame:
    """region, key and n of the sets that share a shingle of their prefixes with another."""
    found = shared(sets, "hashes", distinct=True)
    own = F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("own")
    own = found.groupBy("cell").agg(own, F.count("*").alias("met"))
    size = F.col("n")
    room = size - F.call_function("div", size * percent + 99, F.lit(100)) + 1
    # Shingles that no other set has come first and fill the prefix.
    room = room - (size - F.col("met"))
    rows = sets.select("cell", "key", "n").join(own, "cell").where(room >= 1)
    prefix = F.slice("own.shingle", F.lit(1), room.cast("int"))
    rows = settled(rows.select("key", "n", F.explode(prefix).alias("shingle")))
    firsts = rows.groupBy("shingle").agg(F.min("key").alias("first"), F.count("*").alias("many"))
    firsts = firsts.where("many > 1").drop("many")
    links = rows.join(firsts, "shingle").select("first", "key").distinct()
    roots = components(links, "first", "key")
    members = rows.select("key", "n").distinct().join(roots, F.col("key") == F.col("node"))
    return settled(members.select(F.xxhash64("root").alias("region"), "key", "n"))


def overlaps(members: np.ndarray, sizes: np.ndarray, own: np.ndarray, marked: np.ndarray):
    """How many members each of the sets that lie one behind the other has in common with one."""
    marked[own] = True
    both = np.add.reduceat(marked[members], np.cumsum(sizes) - sizes, dtype=np.int64)
    marked[own] = False
    return both


def alike(both, size, other, percent: int):
    return 100 * both >= percent * (size + other - both)


def cells(apart: np.ndarray, near: np.ndarray, reach: float) -> list[np.ndarray]:
    """Places of the documents in the cell of each pivot, and in the far cell, by the distances
    ``apart`` [document, pivot]; ``near`` says who is linked to which pivot."""
    home = apart.min(axis=1)
    outside = np.where(near, np.inf, apart).min(axis=0)
    window = np.minimum(FAR + reach, home + 2 * reach)[:, None] + ROUNDING
    closed = near & (apart + reach + ROUNDING < outside[None])
    inside = (apart <= window) & ~closed
    return [np.flatnonzero(c) for c in (*inside.T, home > FAR)]


def in_common(sets: list[np.ndarray]) -> np.ndarray:
    """How many members any two of the sets have in common [one, other], as exact floats; what a
    set has in common with itself may lack members of few sets."""
    sizes = np.array([len(s) for s in sets])
    members, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(members, kind="stable")
    members, owners = members[order], owners[order]
    starts = np.flatnonzero(np.append(True, members[1:] != members[:-1]))
    counts = np.diff(np.append(starts, len(members)))
    both = np.zeros((len(sets), len(sets)), np.float32 if sizes.max() < 1 << 24 else np.float64)
    often = counts >= max(2, COMMON * len(sets))
    # Rarer members, pair by pair: each entry and the one so many places behind it.
    rare = np.repeat(~often & (counts > 1), counts)
    columns, rows = np.repeat(np.arange(len(counts)), counts)[rare], owners[rare]
    at, behind, flat = np.arange(len(rows)), 1, both.reshape(-1)
    while len(at):
        at = at[: np.searchsorted(at, len(rows) - behind)]
        at = at[columns[at] == columns[at + behind]]
        np.add.at(flat, rows[at] * len(sets) + rows[at + behind], 1)
        behind += 1
    both = both + both.T
    ends = np.cumsum(counts[often])
    rows, width = owners[np.repeat(often, counts)], max(1, BLOCK // len(sets))
    for first in range(0, len(ends), width):
        part = ends[first : first + width]
        begin = ends[first - 1] if first else 0
        block = np.zeros((len(sets), len(part)), both.dtype)
        own = np.diff(np.append(begin, part))
        block[rows[begin : part[-1]], np.repeat(np.arange(len(part)), own)] = 1
        both += block @ block.T
    return both


def leaf(at: np.ndarray, sets: list[np.ndarray], percent: int) -> list:
    """Links (place, place of the first of its group) that join all alike sets."""
    sizes, both = np.array([len(sets[i]) for i in at]), in_common([sets[i] for i in at])
    near = np.empty(both.shape, bool)
    for first in range(0, len(at), 256):
        part = slice(first, first + 256)
        near[part] = alike(both[part].astype(np.int64), sizes[part, None], sizes[None], percent)
    links, left = [], np.ones(len(at), bool)
    for first in range(len(at)):
        fresh = np.array([first]) if left[first] else []
        left[first] = False
        while len(fresh):
            fresh = np.flatnonzero(left & near[fresh].any(axis=0))
            left[fresh] = False
            links += [(int(i), int(at[first])) for i in at[fresh]]
    return links


def smaller(many: np.ndarray, before: int) -> bool:
    """Whether comparing all pairs of each of the cells is less than doing so in their region."""
    return float((many.astype(float) ** 2).sum()) <= (SMALLER * before) ** 2


def joining(links: list, group: np.ndarray) -> list:
    """Those of the links that join two groups of places, which then are one in ``group``."""
    kept = []
    for a, b in links:
        if group[a] != group[b]:
            group[group == group[a]] = group[b]
            kept.append((a, b))
    return kept


def joined(at: np.ndarray, sets: list[np.ndarray], marked: np.ndarray, percent: int) -> list:
    """Links that join all alike sets among the places ``at``: cells of pivots, recursively.

    At most one link per place. A cell whose places are joined already has nothing to add.
    """
    links, waiting, group = [], [at], np.arange(len(sets))
    while waiting:
        at = waiting.pop()
        if (group[at] == group[at[0]]).all():
            continue
        if len(at) <= LEAF:
            links += joining(leaf(at, sets, percent), group)
            continue
        sizes = np.array([len(sets[i]) for i in at])
        members = np.concatenate([sets[i] for i in at])
        # Pivots from all over the range of sizes.
        chosen = np.argsort(sizes, kind="stable")[np.linspace(0, len(at) - 1, PIVOTS).astype(int)]
        both = np.stack([overlaps(members, sizes, sets[at[p]], marked) for p in chosen], axis=1)
        all_sizes = sizes[:, None] + sizes[chosen][None] - both
        near = alike(both, sizes[:, None], sizes[chosen][None], percent)
        for column, p in enumerate(chosen.tolist()):
            links += joining([(int(i), int(at[p])) for i in at[near[:, column]]], group)
        found = cells(1 - both / all_sizes, near, 1 - percent / 100)
        if smaller(np.array([len(c) for c in found]), len(at)):
            waiting += [at[c] for c in found if len(c) > 1]
        else:
            links += joining(leaf(at, sets, percent), group)
    return links


def dense(sets: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The sets with their members numbered, and room to mark each number."""
    known, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum([len(s) for s in sets])
    return np.split(numbers, ends[:-1]), np.zeros(len(known), bool)


def groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """Rows of each group (of equal first columns) of rows that come sorted."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                columns = [part.column(c).to_pylist() for c in names]
                hashes = part.column("hashes")
                for i, row in enumerate(zip(*columns, strict=True)):
                    values = hashes[i].values.to_numpy(zero_copy_only=False)
                    yield (*row, values.astype(np.int64))

    return groupby(rows(), lambda row: row[:2])


def link_batch(links: list[tuple], keys: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array([keys[i[side]] for i in links], pa.binary()) for side in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


def join_regions(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the members (region, tile, key) of regions that fit in a task each, fewer
    than a region and tile has members."""
    rows = members.join(sets.select("key", "hashes"), "key")
    rows = rows.repartition("region", "tile").sortWithinPartitions("region", "tile", "key")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groups(batches, ["region", "tile", "key"]):
            rows = list(group)
            if len(rows) > 1:
                own, marked = dense([r[3] for r in rows])
                links = joined(np.arange(len(own)), own, marked, percent)
                if links:
                    yield link_batch(links, [r[2] for r in rows])

    return map_batches(rows.select("region", "tile", "key", "hashes"), "a binary, b binary", work)


def sizes_of(members: DataFrame) -> DataFrame:
    """region, many and parts: how many tasks it would fill."""
    parts = F.ceil(F.greatest(F.count("*") / MOST_ROWS, F.sum("n") / MOST_SHINGLES))
    return members.groupBy("region").agg(F.count("*").alias("many"), parts.cast("int").alias("parts"))


def placed(large: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Written once: region, many, key, n, and for each pivot of the region: its key, distance
    and whether it is linked.

    ``large`` has region, many, parts, key and n. Members of a region are dealt out to its parts;
    the pivots, of bounded number and length, are repeated for each part.
    """
    order = Window.partitionBy("region").orderBy(F.xxhash64("key"), "key")
    taken = large.withColumn("number", F.row_number().over(order)).where(F.col("number") <= PIVOTS)
    through = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    taken = taken.withColumn("through", through)
    taken = taken.where((F.col("number") == 1) | (F.col("through") <= MOST_SHINGLES))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    pivots = taken.withColumns({"part": every, "kind": F.lit(0)}).drop("number", "through")
    own = F.pmod(F.xxhash64("key", F.lit(1)), F.col("parts")).cast("int")
    both = pivots.unionByName(large.withColumns({"part": own, "kind": F.lit(1)}))
    rows = both.join(sets.select("key", "hashes"), "key").repartition("region", "part")
    rows = rows.sortWithinPartitions("region", "part", "kind", "key")
    names = ["region", "part", "kind", "many", "key", "n"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (region, _), group in groups(batches, names):
            pivots, made = [], []
            for _, _, kind, many, key, n, hashes in group:
                if kind == 0:
                    pivots.append((key, n, hashes))
                    continue
                own = []
                for pivot, size, others in pivots:
                    places = np.searchsorted(others, hashes)
                    found = others[np.minimum(places, size - 1)] == hashes
                    both = int(found.sum())
                    near = bool(alike(both, n, size, percent))
                    own.append((pivot, 1 - both / (n + size - both), near))
                made.append((region, many, key, n, own))
                if len(made) == 1024:
                    yield placed_batch(made)
                    made = []
            if made:
                yield placed_batch(made)

    kind = "array<struct<pivot:binary,apart:double,near:boolean>>"
    schema = f"region bigint, many bigint, key binary, n bigint, pivots {kind}"
    return settled(map_batches(rows.select(*names, "hashes"), schema, work))


def placed_batch(rows: list[tuple]) -> pa.RecordBatch:
    pivot = pa.struct([("pivot", pa.binary()), ("apart", pa.float64()), ("near", pa.bool_())])
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pivot)]
    names = ["region", "many", "key", "n", "pivots"]
    columns = list(zip(*rows, strict=True))
    columns[4] = [
        [dict(zip(("pivot", "apart", "near"), p, strict=True)) for p in own] for own in columns[4]
    ]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def cut(members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links to pivots, and the cells as new regions: parent (the region before), many (of the
    parent), region, key, n.

    The same cells as :func:`cells`, over tables.
    """
    reach = 1 - percent / 100
    home = F.array_min(F.transform("pivots", lambda p: p["apart"])).alias("home")
    rows = members.select("region", "many", "key", "n", home, F.inline("pivots"))
    links = rows.where("near and key <> pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    outside = F.coalesce(F.min(F.when(~F.col("near"), F.col("apart"))), F.lit(2.0))
    outside = rows.groupBy("region", "pivot").agg(outside.alias("outside"))
    window = F.least(F.lit(FAR + reach), F.col("home") + 2 * reach) + ROUNDING
    closed = F.col("near") & (F.col("apart") + reach + ROUNDING < F.col("outside"))
    inside = rows.join(outside, ["region", "pivot"]).where((F.col("apart") <= window) & ~closed)
    parent = F.col("region").alias("parent")
    child = F.xxhash64("region", "pivot").alias("region")
    near = inside.select(parent, "many", child, "key", "n")
    far = members.select("region", "many", "key", "n", home).where(F.col("home") > FAR)
    child = F.xxhash64("region", F.lit(FAR_CELL)).alias("region")
    return links, near.union(far.select(parent, "many", child, "key", "n"))


def not_smaller(cells: DataFrame) -> DataFrame:
    """Written once: region, of the parents that cutting into these cells does not make smaller,
    as :func:`smaller` has it."""
    many = cells.groupBy("parent", "region").agg(F.count("*").alias("own"), F.first("many").alias("many"))
    pairs = F.sum(F.col("own").cast("double") * F.col("own")).alias("pairs")
    whole = many.groupBy("parent").agg(pairs, F.first("many").alias("many"))
    stuck = F.col("pairs") > F.pow(SMALLER * F.col("many"), F.lit(2.0))
    return settled(whole.where(stuck).select(F.col("parent").alias("region")))


def tiles(large: DataFrame) -> DataFrame:
    """region, tile and key: any two members of a region share a tile, and each tile fits in a
    task."""
    half = F.pmod(F.xxhash64("key", F.lit(2)), 2 * F.col("parts")).cast("int")
    every = F.transform(
        F.sequence(F.lit(0), 2 * F.col("parts") - 1),
        lambda other: F.least(other, half) * 2 * F.col("parts") + F.greatest(other, half),
    )
    return large.select("region", F.explode(every).alias("tile"), "key")


def links_of(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join all alike sets of the members (region, key, n) of each region."""
    ready, found = [], []
    now = members
    while True:
        sized = settled(now.join(sizes_of(now), "region"))
        ready.append(sized.where("parts = 1").withColumn("tile", F.lit(0)).select("region", "tile", "key"))
        large = sized.where("parts > 1").select("region", "many", "parts", "key", "n")
        if large.isEmpty():
            break
        links, children = cut(placed(large, sets, percent), percent)
        found.append(links)
        children = settled(children)
        stuck = not_smaller(children)
        ready.append(tiles(large.join(stuck, "region")))
        kept = children.join(stuck.withColumnRenamed("region", "parent"), "parent", "left_anti")
        now = kept.select("region", "key", "n")
    rows = ready[0]
    for more in ready[1:]:
        rows = rows.union(more)
    links = join_regions(rows, sets, percent)
    for more in found:
        links = links.union(more)
    return links


def join(
    documents: DataFrame, id_column: str, text: str, shingle: int = 5, percent: int = 80
) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest id that links of at least
    ``percent`` per cent similarity reach, itself included."""
    survey = surveyed(documents, id_column, text, shingle, percent)
    chosen = candidates(survey, percent)
    sets = with_sets(documents, id_column, text, chosen, shingle)
    roots = components(links_of(root_regions(sets, percent), sets, percent), "a", "b")
    least = survey.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    least = least.join(roots, F.col("key") == F.col("node"), "left")
    least = settled(least.select("key", "least", F.coalesce("root", "key").alias("root")))
    whole = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = least.join(whole, "root").select("key", "component_id")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return survey.select("doc_id", "n_shingles", "key").join(named, "key", "left").select(
        "doc_id", "n_shingles", own.alias("component_id")
    )
