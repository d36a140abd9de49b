"""SimHash fingerprints, near-duplicates by bit-sliced comparison, and exact set similarity.

Blocks. ``near`` finds fingerprints that differ in at most ``radius`` bits. The 64 bits are cut
into ``radius + 2`` bands; two fingerprints within the radius agree in at least two of them, so
every pair of bands makes a key, and only fingerprints with a common key are compared. Keys with
more than ``TILE`` fingerprints are split into tiles of two parts each, so that all pairs of
parts meet in some task and no task holds more than two parts. Nothing is left out.

Comparison. The fingerprints of a task's block are stored as bit planes (plane b holds bit b of
64 fingerprints per word). For all fingerprints of the block at once the differing bits are
added up plane by plane in carry-save counters, started so that the last carry means "beyond
the radius"; the block is left as soon as that is set for all pairs.

Only a spanning forest of a block's links is handed on: as many rows as fingerprints at most.

Equal fingerprints are compared once. Null or empty texts have the fingerprint zero.

Similarity. ``one_of_each`` uses wide fingerprints only to find groups that no similar pair can
leave; within each group the sets of shingles themselves decide.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain, combinations, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import (
    SLICE_ROWS,
    content_key,
    map_batches,
    map_texts,
    quoted,
    settled,
    unused,
)
from lagline.llm.components import components

BITS = 64
SEED = 42
TILE = 2048
BLOCK = 512
MARGIN = 4
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of every shingle of ``size`` words, repeats included."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([digest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1]
    parts = zip(begins.tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(line[a:b], SEED) for a, b in parts), np.uint64, len(begins))


def bit_counts(words: np.ndarray) -> np.ndarray:
    """How many rows of ``words`` [n, lanes] have each bit set, lowest bit first, by carry-save
    adders: three rows of one weight become a row of that weight and one of twice the weight."""
    counts = np.zeros(words.shape[1] * 64, np.int64)
    weight = 1
    while len(words):
        carries = []
        while len(words) > 2:
            third = len(words) // 3
            one, two, three = (words[i * third : (i + 1) * third] for i in range(3))
            half = one ^ two
            carries.append((one & two) | (half & three))
            words = np.concatenate((half ^ three, words[3 * third :]))
        bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")
        counts += weight * bits.sum(axis=0, dtype=np.int64)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half the hashes, as an unsigned number."""
    if not len(hashes):
        return 0
    return int(majority(hashes.reshape(-1, 1))[0])


def majority(words: np.ndarray) -> np.ndarray:
    """Bits set in over half the rows of ``words`` [n, lanes], as one row."""
    return np.packbits(bit_counts(words) * 2 > len(words), bitorder="little").view(np.uint64)


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(documents: DataFrame, id_column: str, text: str, shingle: int) -> DataFrame:
    """doc_id and the fingerprint as a signed long, ``print``."""

    def start() -> Callable[[list], list]:
        return lambda texts: [[signed(fingerprint(shingle_hashes(t, shingle))) for t in texts]]

    rows = documents.select(
        F.col(quoted(id_column)).alias("doc_id"), F.col(quoted(text)).alias("text")
    )
    return map_texts(rows, "text", [("print", "bigint", pa.int64())], start)


def beyond(lanes: np.ndarray, queries: np.ndarray, radius: int, own: int) -> np.ndarray:
    """Bits [query, lane word]: set where a lane differs from the query in over ``radius`` bits.

    ``lanes`` and ``queries`` are arrays [n, words of a fingerprint] of unsigned longs. Query i
    stands in lane ``own`` + i and is not compared with itself: its bit is set. Queries that all
    lanes are beyond are left on the way.
    """
    count, width = lanes.shape
    words = -(-count // 64)
    spread = np.zeros((words * 64, width), np.uint64)
    spread[:count] = lanes
    bits = np.unpackbits(spread.view(np.uint8), axis=1, bitorder="little")
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    planes = planes.view(np.uint64)
    bits = np.unpackbits(np.ascontiguousarray(queries).view(np.uint8), axis=1, bitorder="little")
    flips = np.where(bits, FULL, np.uint64(0)).T
    never = np.zeros((len(queries), words * 64), bool)
    never[:, count:] = True
    never[np.arange(len(queries)), own + np.arange(len(queries))] = True
    out = np.packbits(never, axis=1, bitorder="little").view(np.uint64)
    size = radius.bit_length()
    start = (1 << size) - (radius + 1)
    active = np.arange(len(queries))
    over = out.copy()
    counters = [
        np.full((len(queries), words), FULL if start >> k & 1 else 0, np.uint64)
        for k in range(size)
    ]
    for plane in range(width * 64):
        carry = planes[plane][None] ^ flips[plane][active][:, None]
        for k in range(size):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if plane % 8 == 7:
            done = (over == FULL).all(axis=1)
            if done.any():
                out[active[done]] = FULL
                active, over = active[~done], over[~done]
                counters = [c[~done] for c in counters]
                if not len(active):
                    return out
    out[active] = over
    return out


def forest(prints: np.ndarray, radius: int, sieve: int = 0) -> list[tuple[int, int]]:
    """Links (position, position of the first of its group) that join all near fingerprints.

    Wide fingerprints are first compared by the bits of their first ``sieve`` words, with a
    radius that has ``MARGIN`` standard errors to spare; what is left is counted in full.
    """
    count, width = prints.shape
    if count < 2:
        return []
    part_width, part_radius = width, radius
    if sieve:
        share = radius / (64 * width)
        part_width = sieve
        part_radius = math.ceil(
            64 * sieve * share + MARGIN * math.sqrt(64 * sieve * share * (1 - share))
        )
    reach = np.zeros((count, -(-count // 64)), np.uint64)
    for first in range(0, count, 256):
        part = prints[first : first + 256, :part_width]
        reach[first : first + 256] = ~beyond(prints[:, :part_width], part, part_radius, first)
    seen = np.zeros(reach.shape[1] * 64, bool)
    bits = reach.view(np.uint8)
    links = []
    for first in np.flatnonzero(reach.any(axis=1)).tolist():
        if seen[first]:
            continue
        seen[first] = True
        queue = [first]
        while queue:
            at = queue.pop()
            row = np.unpackbits(bits[at], bitorder="little").astype(bool)
            fresh = np.flatnonzero(row & ~seen)
            if sieve and len(fresh):
                apart = np.bitwise_count(prints[fresh] ^ prints[at]).sum(axis=1)
                fresh = fresh[apart <= radius]
            seen[fresh] = True
            links += [(i, first) for i in fresh.tolist()]
            queue += fresh.tolist()
    return links


def blocks(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of runs of whole groups (equal keys) of rows that come sorted by the key.

    A block ends with the group that brings it to ``BLOCK`` rows; groups of one row are left out.
    """
    held: list[pa.Table] = []
    for batch in chain(_tables(batches), [None]):
        if batch is not None:
            held.append(batch)
            rows = pa.concat_tables(held).combine_chunks()
        elif held:
            rows = pa.concat_tables(held).combine_chunks()
        else:
            return
        columns = {n: _values(rows.column(n)) for n in rows.column_names}
        change = np.zeros(len(rows), bool)
        if len(rows):
            change[0] = True
        for name in key:
            change[1:] |= columns[name][1:] != columns[name][:-1]
        starts = np.flatnonzero(change)
        ends = np.append(starts[1:], len(rows))
        if batch is not None and len(starts):  # the last group may go on
            keep = starts[-1]
            held = [rows.slice(keep)]
            starts, ends = starts[:-1], ends[:-1]
        several = ends - starts > 1
        starts, ends = starts[several], ends[several]
        begin = 0
        sizes = np.cumsum(ends - starts)
        while begin < len(starts):
            done = sizes[begin - 1] if begin else 0
            last = int(np.searchsorted(sizes, done + BLOCK)) + 1
            chosen = slice(begin, last)
            places = np.concatenate(
                [np.arange(a, b) for a, b in zip(starts[chosen], ends[chosen], strict=True)]
            )
            yield {n: v[places] for n, v in columns.items()}
            begin = last


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    for batch in batches:
        if batch.num_rows:
            yield pa.Table.from_batches([batch])


def _values(column: pa.ChunkedArray) -> np.ndarray:
    if pa.types.is_binary(column.type) or pa.types.is_fixed_size_binary(column.type):
        out = np.empty(len(column), object)
        out[:] = column.to_pylist()
        return out
    return column.to_numpy()


def tiled(rows: DataFrame, key: str, member: str, most: int = TILE) -> DataFrame:
    """Rows with ``tile``: 0 for keys of up to ``most`` rows; rows of larger keys are repeated
    so that any two of them share some tile, and a tile holds about 2 * ``most`` rows."""
    large = rows.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > most)
    parts = F.ceil(F.col("__n") / most).cast("int")
    return in_tiles(rows, large.select(key, parts.alias("__parts")), key, member)


def in_tiles(rows: DataFrame, parts: DataFrame, key: str, member: str) -> DataFrame:
    """Rows with ``tile``: any two of a key in ``parts`` (with its number ``__parts``) share some
    tile of two parts; other keys have the tile 0."""
    joined = rows.join(parts, key, "left")
    own = F.pmod(F.xxhash64(member), F.col("__parts")).cast("int")
    joined = joined.withColumn("__own", own)
    tiles = F.when(F.col("__parts").isNull(), F.array(F.lit(0))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("__parts") - 1),
            lambda other: F.least(other, F.col("__own")) * F.col("__parts")
            + F.greatest(other, F.col("__own")),
        )
    )
    return joined.withColumn("tile", F.explode(tiles)).drop("__parts", "__own")


def near(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``print``) within the radius: at least
    a spanning forest of each group of such fingerprints."""
    cuts = [round(i * BITS / (radius + 2)) for i in range(radius + 3)]
    bands = [
        F.shiftrightunsigned("print", a).bitwiseAND(F.lit((1 << (b - a)) - 1))
        for a, b in zip(cuts, cuts[1:], strict=False)
    ]
    keys = [
        F.struct(F.xxhash64(F.lit(i), bands[p], bands[q]).alias("key"))
        for i, (p, q) in enumerate(combinations(range(len(bands)), 2))
    ]
    rows = prints.select("print", F.explode(F.array(*keys)).alias("k")).select("k.key", "print")
    rows = tiled(rows, "key", "print")
    sorted_rows = rows.repartition("key", "tile").sortWithinPartitions("key", "tile", "print")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, ["key", "tile"]):
            values = np.unique(block["print"])
            links = forest(values.view(np.uint64).reshape(-1, 1), radius)
            if links:
                places = np.array(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[places[:, 0]]), pa.array(values[places[:, 1]])], ["a", "b"]
                )

    return map_batches(sorted_rows, "a bigint, b bigint", compare)


def linked(documents: DataFrame, id_column: str, text: str, shingle: int, radius: int) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits) and component_id, the smallest id that
    links of at most ``radius`` differing bits reach (null only if none of these has an id)."""
    rows = settled(fingerprints(documents, id_column, text, shingle))
    prints = rows.groupBy("print").agg(F.min("doc_id").alias("least"))
    roots = components(near(prints.select("print"), radius), "a", "b")
    rooted = prints.join(roots, prints["print"] == roots["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("print", "component_id")
    return rows.join(named, "print", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: Of the similarity stage: words of 64 bits in a fingerprint, of these in the sieve, smallest
#: hashes in a block key at most, and block keys.
LANES, SIEVE, ROWS, KEYS = 16, 4, 4, 40
MIXERS = np.array(
    [xxhash.xxh64_intdigest(b"mix%d" % i) | 1 for i in range(LANES + ROWS * KEYS)], np.uint64
)
#: Up to so many shingles, texts are blocked by prefixes of their sets.
SHORT = 69
#: Share of the pairs at the limit that the block keys of longer texts may miss, and standard
#: errors that the fingerprints of a pair at the limit have to spare.
MISSED, SPARE = 1e-9, 6
#: Shingles of the texts in a part of a tile.
TILE_SHINGLES = 1 << 21


@cache
def share_of(both: int, one: int, other: int) -> float:
    """Chance that a bit of two fingerprints differs: sets with ``both`` shingles in common and
    ``one`` and ``other`` of their own."""

    def more(own: int) -> list[float]:
        """Per number of common shingles with the bit: chance that over half of the set has it."""
        size = both + own
        return [
            sum(math.comb(own, i) for i in range(own + 1) if 2 * (k + i) > size) / 2**own
            for k in range(both + 1)
        ]

    return sum(
        math.comb(both, k) / 2**both * (p + q - 2 * p * q)
        for k, (p, q) in enumerate(zip(more(one), more(other), strict=True))
    )


def radius_of(similarity: float, bits: int, short: bool) -> int:
    """Differing bits that no two texts of so similar shingle sets (Jaccard) exceed, but for a
    chance of ``SPARE`` standard errors; ``short`` is for texts of up to ``SHORT`` shingles,
    where ties of even counts make more bits differ."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    for large in range(1, SHORT + 1) if short else ():
        for small in range(math.ceil(similarity * large - 1e-9), large + 1):
            both = math.ceil(similarity * (large + small) / (1 + similarity) - 1e-9)
            if both <= small:
                share = max(share, share_of(both, large - both, small - both))
    return math.ceil(bits * share + SPARE * math.sqrt(bits * share * (1 - share)))


def rows_of(similarity: float) -> int:
    """Smallest hashes in a block key, so that two texts at the limit have a common key but for
    ``MISSED``; 0 if one is too many already."""
    if similarity >= 1:
        return ROWS
    return min(ROWS, int(math.log(1 - MISSED ** (1 / KEYS)) / math.log(similarity)))


def block_keys(distinct: np.ndarray, similarity: float) -> list[int]:
    """Keys of which two texts of that similarity have one in common: odd ones for two of up to
    ``SHORT`` shingles, even ones for two of which one has more.

    Short: the smallest shingle hashes, one more than the larger set may lack; that misses none.
    """
    count, rows = len(distinct), rows_of(similarity)
    keys = []
    if count <= SHORT or not rows:
        prefix = count - math.ceil(similarity * count - 1e-9) + 1
        keys += [xxhash.xxh64_intdigest(h.tobytes(), KEYS) | 1 for h in distinct[:prefix]]
    if rows and count >= similarity * (SHORT + 1) - 1e-9:
        least = np.full(rows * KEYS, FULL)
        mixers = MIXERS[None, LANES : LANES + rows * KEYS]
        for first in range(0, count, 2048):
            part = distinct[first : first + 2048, None] * mixers
            least = np.minimum(least, part.min(axis=0))
        for i, row in enumerate(least.reshape(KEYS, -1)):
            keys.append(xxhash.xxh64_intdigest(row.tobytes(), i) & ~1)
    return [signed(k) for k in keys]


def wide_print(distinct: np.ndarray) -> bytes:
    """A fingerprint of ``LANES`` words from the distinct shingles."""
    if not len(distinct):
        return bytes(8 * LANES)
    carried = []
    for first in range(0, len(distinct), 2048):
        part = distinct[first : first + 2048, None] * MIXERS[None, :LANES]
        part ^= part >> np.uint64(32)
        carried.append(part * MIXERS[0])
    return majority(np.concatenate(carried)).tobytes()


def alike(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links (position, position of the first of its group) that join all sets (without repeats,
    none empty) of at least that Jaccard similarity."""
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    known, members = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(len(known), bool)
    left, rest = np.arange(len(sets)), members  # not yet reached, and their members

    def drop(gone: np.ndarray) -> None:
        nonlocal left, rest
        rest = rest[np.repeat(~gone, sizes[left])]
        left = left[~gone]

    links = []
    while len(left):
        first = int(left[0])
        queue = [first]
        drop(left == first)
        while queue and len(left):
            at = queue.pop()
            own = members[ends[at] - sizes[at] : ends[at]]
            marked[own] = True
            starts = np.cumsum(sizes[left]) - sizes[left]
            both = np.add.reduceat(marked[rest], starts, dtype=np.int64)
            marked[own] = False
            near = both / (sizes[left] + sizes[at] - both) >= similarity
            if near.any():
                fresh = left[near].tolist()
                links += [(i, first) for i in fresh]
                queue += fresh
                drop(near)
    return links


def settled_pairs(
    documents: DataFrame, texts: DataFrame, groups: DataFrame, shingle: int, similarity: float
) -> DataFrame:
    """Links (a, b) between the keys of texts of that similarity, by their sets of shingles.

    ``documents`` has at, key and text, ``texts`` key, least (the smallest at) and n (shingles),
    ``groups`` node (a key) and root. All pairs of a group are compared, but for such as are
    joined already. Groups too large for one task are dealt out to tiles.
    """
    members = texts.join(groups, F.col("key") == F.col("node")).select("key", "least", "n", "root")
    parts = F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n") / TILE_SHINGLES))
    large = members.groupBy("root").agg(parts.cast("int").alias("__parts")).where("__parts > 1")
    owners = members.select(F.col("key").alias("own"), "least")
    found = documents.join(owners, (F.col("key") == F.col("own")) & (F.col("at") == F.col("least")))
    found = found.select("key", "text").dropDuplicates(["key"])
    met = found.join(in_tiles(members.select("key", "root"), large, "root", "key"), "key")
    met = met.repartition("root", "tile").sortWithinPartitions("root", "tile", "key")
    met = met.select("root", "tile", "key", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(first, SLICE_ROWS)
                yield from zip(*[c.to_pylist() for c in part.columns], strict=True)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(rows(batches), lambda row: row[:2]):
            keys, sets = [], []
            for _, _, key, text in group:
                keys.append(key)
                sets.append(np.unique(shingle_hashes(text, shingle)))
            links = alike(sets, similarity)
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[i[side]] for i in links], pa.binary()) for side in (0, 1)],
                    ["a", "b"],
                )

    return map_batches(met, "a binary, b binary", compare)


def one_of_each(
    documents: DataFrame, id_column: str, text: str, shingle: int = 5, similarity: float = 0.8
) -> DataFrame:
    """The documents without near-duplicates: of each group the one with the smallest id stays,
    all columns.

    Texts are alike if the sets of their runs of ``shingle`` words have at least that Jaccard
    similarity. Groups to be compared come from fingerprints of 1,024 bits, at a radius with
    ``SPARE`` standard errors to spare. Such a radius is too wide for bands of bits, so blocks
    are formed by smallest hashes of shingles instead (``block_keys``). The sets decide then.

    Equal texts are one text, whatever their length. Null ids come last; of rows with one id and
    one text, one stays. Texts without a word only match equal texts; null counts as empty.
    """
    radii = [radius_of(similarity, 64 * LANES, short) for short in (False, True)]
    if not rows_of(similarity):  # all texts have odd keys
        radii[1] = max(radii)

    def start() -> Callable[[list], list]:
        def work(texts: list) -> list:
            sets = [np.unique(shingle_hashes(t, shingle)) for t in texts]
            keys = [block_keys(s, similarity) if len(s) else [] for s in sets]
            return [[wide_print(s) for s in sets], [len(s) for s in sets], keys]

        return work

    ids = F.col(quoted(id_column)).cast("bigint")
    content = F.col(quoted(text))
    rows = documents.select(
        F.coalesce(ids, F.lit((1 << 63) - 1)).alias("at"),
        content_key(content).alias("key"),
        content.alias("text"),
    )
    fields = [
        ("print", "binary", pa.binary()),
        ("n", "bigint", pa.int64()),
        ("blocks", "array<bigint>", pa.list_(pa.int64())),
    ]
    survey = settled(map_texts(rows, "text", fields, start))
    texts = survey.groupBy("key").agg(
        F.min("at").alias("least"),
        F.first("print").alias("print"),
        F.first("n").alias("n"),
        F.first("blocks").alias("b"),
    )
    texts = settled(texts)
    blocked = texts.select("key", F.explode("b").alias("block"))
    several = blocked.groupBy("block").agg(F.count("*").alias("n")).where("n > 1").select("block")
    met = blocked.join(several, "block").join(texts.select("key", "print"), "key")
    met = tiled(met, "block", "key")
    met = met.repartition("block", "tile").sortWithinPartitions("block", "tile", "key")
    met = met.select("block", "tile", "key", "print")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, ["block", "tile"]):
            for short, radius in enumerate(radii):
                own = (part["block"] & 1) == short
                keys, at = np.unique(part["key"][own], return_index=True)
                prints = b"".join(part["print"][own][at])
                prints = np.frombuffer(prints, np.uint64).reshape(-1, LANES)
                links = forest(prints, radius, SIEVE)
                if links:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([keys[i[side]] for i in links], pa.binary()) for side in (0, 1)],
                        ["a", "b"],
                    )

    groups = components(map_batches(met, "a binary, b binary", compare), "a", "b")
    links = settled_pairs(rows, texts.select("key", "least", "n"), groups, shingle, similarity)
    roots = components(links, "a", "b")
    rooted = texts.select("key", "least").join(roots, F.col("key") == F.col("node"), "left")
    rooted = rooted.select("key", "least", F.coalesce("root", "key").alias("root"))
    # The first text of each group, by id and then by content.
    kept = rooted.groupBy("root").agg(F.min(F.struct("least", "key")).alias("kept"))
    key, least, n = (unused(documents, name) for name in ("key", "least", "n"))
    kept = kept.select(F.col("kept.key").alias(key), F.col("kept.least").alias(least))
    again = survey.groupBy("key", "at").agg(F.count("*").alias(n)).where(F.col(n) > 1)
    again = again.select(F.col("key").alias(key), F.col("at").alias(least), n)
    kept = settled(kept.join(again, [key, least], "left"))
    columns = [quoted(c) for c in documents.columns]
    named = documents.withColumns(
        {key: content_key(content), least: F.coalesce(ids, F.lit((1 << 63) - 1))}
    )
    found = named.join(kept, [key, least])
    once = found.where(F.col(n).isNull()).select(*columns)
    repeated = found.where(F.col(n).isNotNull()).dropDuplicates([key, least])
    return once.union(repeated.select(*columns))
