"""Repeated passages by sparse suffix arrays.

Only suffixes at content-selected places are kept: the places of the smallest run hash in each
window of words (see ``grams``), of these only such as some other text has too. A kept suffix is
represented by its anchor, ``WINDOW`` words to the right and ``GRAM`` words to the left, 32 bits
a word. All are sorted over the cluster (ranges of anchor, right side, left side, id), each is
compared with its neighbours of other texts, and the match is extended to the right and to the
left. A second sort has the left side before the right side, so that a text is also next to those
that share most to its left. Matches of ``WINDOW`` words or more count; overlapping ones become
one passage.

In the one order a suffix stands beside those that share most to its right, in the other beside
those that share most to its left. Between these two reaches a window can be shared with a text
that is a neighbour in neither order. Where more suffixes have an anchor than are compared,
such windows that no match covers are settled by their words: suffixes with the anchor are grouped
by the words that the window has on either side of their place. So no match is missed.

Equal suffixes may lie in several ranges, so a suffix that very many texts share does not make
one large task; the first and last suffixes of each range (two texts' worth) are compared in a
last step over as many rows as there are ranges.

Copies of a text are handled once per text: each copy is one passage, its whole text. Null ids
take part and are returned as null. Texts of under ``WINDOW`` words have no passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm import grams
from lagline.llm.common import map_batches, settled
from lagline.llm.grams import GRAM, LAST_ID, SPAN, WINDOW

ORDERS = (
    ["anchor", "right", "left", "first", "key", "place"],
    ["anchor", "left", "right", "first", "key", "place"],
)
SCHEMA = "key binary, first bigint, anchor bigint, place bigint, right binary, left binary"
MADE = "kind int, begin bigint, end bigint, other bigint, " + SCHEMA
KINDS = [
    pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(),
    pa.int64(), pa.binary(), pa.binary(),
]
WIDTH = 4
#: How many neighbours before it, of other texts, a suffix is compared with.
NEIGHBOURS = 8
STRIDE = 16


def kept_suffixes(known: grams.WordCodes, text: str, shared: np.ndarray) -> list[tuple]:
    """(anchor, place, right words, left words reversed) of the kept suffixes of a text.

    Where one word goes on and on, all its run hashes are equal and every place is a smallest
    one. There the places are kept that lie a multiple of ``STRIDE`` words before the end of
    the stretch, and its first place: equal stretches keep equal places.
    """
    codes = grams.word_codes(grams.split_words(text), known)
    least, hashes = grams.anchors(codes)
    starts, ends = grams.runs(least)
    wanted = np.isin(least[starts], shared)
    if not wanted.any():
        return []
    short = (codes >> np.uint64(32)).astype(">u4")
    change = np.flatnonzero(hashes[1:] != hashes[:-1])
    last = np.append(change, len(hashes) - 1)
    to_end = last[np.searchsorted(last, np.arange(len(hashes)))] - np.arange(len(hashes))
    picked = to_end % STRIDE == 0
    picked[0] = True
    picked[change + 1] = True
    places = {}
    for a, b in zip(starts[wanted].tolist(), ends[wanted].tolist(), strict=True):
        part = slice(a, b + SPAN - 1)
        inside = np.flatnonzero((hashes[part] == least[a]) & picked[part])
        places.update(dict.fromkeys((a + inside).tolist(), int(grams.as_long(least[a : a + 1])[0])))
    return [
        (
            anchor,
            p,
            short[p : p + WINDOW].tobytes(),
            short[max(p - GRAM, 0) : p][::-1].tobytes(),
        )
        for p, anchor in places.items()
    ]


class Suffix:
    """A kept suffix in a sorted range, and the longest matches found for it."""

    __slots__ = ("row", "key", "anchor", "right", "left", "spans", "other", "reach")

    def __init__(self, row: tuple):
        self.row = row
        self.key, _, self.anchor = row[:3]
        self.right = int.from_bytes(row[4].ljust(WINDOW * WIDTH, b"\0"), "big")
        self.left = int.from_bytes(row[5].ljust(GRAM * WIDTH, b"\0"), "big")
        self.spans: list[tuple[int, int]] = []
        self.other = LAST_ID
        self.reach = (0, 0)  # most words shared to the left and to the right

    def meet(self, old: Suffix) -> None:
        """Extend the match of two suffixes with one anchor to the right and to the left."""
        bits = (self.right ^ old.right).bit_length()
        right = min(WINDOW - -(-bits // 32), len(self.row[4]) // WIDTH, len(old.row[4]) // WIDTH)
        bits = (self.left ^ old.left).bit_length()
        left = min(GRAM - -(-bits // 32), len(self.row[5]) // WIDTH, len(old.row[5]) // WIDTH)
        for one in (self, old):
            one.reach = (max(one.reach[0], left), max(one.reach[1], right))
        if left + right >= WINDOW:
            for one, two in ((self, old), (old, self)):
                one.other = min(one.other, two.row[1])
                if not any(a >= left and b >= right for a, b in one.spans):
                    one.spans.append((left, right))

    def matches(self, crowded: bool) -> list[tuple]:
        """The matches, and if not all suffixes of the anchor were met the reaches (kind 2, to
        the left in begin, to the right in end, in other the splits that the matches cover)."""
        key, first, anchor, place = self.row[:4]
        own = (key, first, anchor, place, b"", b"")
        rows = [(0, place - left, place + right, self.other, *own) for left, right in self.spans]
        if crowded and any(self.reach):
            covered = 0
            for left, right in self.spans:
                covered |= splits_between(left, right)
            rows.append((2, *self.reach, covered, *own))
        return rows


def splits_between(left: int, right: int) -> int:
    """Bits for the numbers of words that a window may have to the left of a place, if so many
    words are shared on either side."""
    low, high = max(WINDOW - right, 0), min(left, SPAN - 1)
    return ((1 << (high + 1)) - (1 << low)) if high >= low else 0


def neighbours(batches: Iterator[pa.RecordBatch], edges: bool) -> Iterator[pa.RecordBatch]:
    """Matches (kind 0) of neighbouring suffixes of different texts in sorted rows, and reaches
    (kind 2). With ``edges`` also the rows of the first and of the last text (kind 1)."""
    before: list[Suffix] = []  # the last rows of texts before the current one
    now: list[Suffix] = []  # the rows of the current text
    first = True
    edge: list[tuple] = []  # the rows of the first text
    count, begun = 0, 1  # rows of the current anchor, and anchors
    names = [part.split()[0] for part in MADE.split(", ")]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(columns, KINDS, strict=True)], names=names
        )

    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            rows: list[tuple] = []
            for values in zip(*[c.to_pylist() for c in part.columns], strict=True):
                row = Suffix(values)
                if now and row.anchor != now[-1].anchor:
                    crowded = begun == 1 or count > NEIGHBOURS
                    rows += [m for old in [*before, *now] for m in old.matches(crowded)]
                    before, now, count, begun = [], [], 0, begun + 1
                    if edges and first:
                        rows += edge
                        first = False
                if now and row.key != now[-1].key:
                    if edges and first:
                        rows += edge
                        first = False
                    for old in now[:-NEIGHBOURS]:
                        # All suffixes of one text in a row meet the first of the next.
                        row.meet(old)
                    kept = [*before, *now]
                    rows += [m for old in kept[:-NEIGHBOURS] for m in old.matches(True)]
                    before, now = kept[-NEIGHBOURS:], []
                for old in before:
                    if old.key != row.key:
                        row.meet(old)
                now.append(row)
                count += 1
                if edges and first:
                    edge.append((1, 0, 0, 0, *row.row))
            if rows:
                yield out(rows)
    rows = [m for old in [*before, *now] for m in old.matches(True)]
    if edges and first:
        rows += edge
    if edges:
        rows += [(1, 0, 0, 0, *own.row) for own in now]
    if rows:
        yield out(rows)


def sorted_matches(rows: DataFrame, order: list[str]) -> DataFrame:
    """Matches of neighbours in one sort of the suffixes, and reaches: kind, begin, end, other,
    key, first, anchor, place."""
    columns = [part.split()[0] for part in SCHEMA.split(", ")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(columns)
    made = settled(map_batches(dealt, MADE, lambda batches: neighbours(batches, True)))
    # As many rows as ranges have ends.
    edges = made.where("kind = 1").select(columns).distinct()
    edges = edges.coalesce(1).sortWithinPartitions(*order)
    last = map_batches(edges, MADE, lambda batches: neighbours(batches, False))
    made = made.where("kind <> 1").union(last)
    return made.select("kind", "begin", "end", "other", "key", "first", "anchor", "place")


def settled_splits(rows: DataFrame, reaches: DataFrame) -> DataFrame:
    """key, begin, end, other: windows that the neighbours of two orders leave open.

    ``reaches`` are the reaches of both orders. A split (words of a window to the left of the place)
    is possible for a suffix if some suffix shares so many words to the left and some as many as
    it needs to the right; it is open if no match covers it. All suffixes of the anchor for which
    an open split is possible are then grouped by the words of that window.
    """
    own = reaches.groupBy("key", "place", "anchor").agg(
        F.max("begin").alias("left"), F.max("end").alias("right"), F.bit_or("other").alias("met")
    )
    low, high = F.greatest(WINDOW - F.col("right"), F.lit(0)), F.least("left", F.lit(SPAN - 1))
    own = settled(own.where(low <= high).withColumn("split", F.explode(F.sequence(low, high))))
    open_split = F.getbit("met", F.col("split").cast("int")) == 0
    wanted = own.where(open_split).select("anchor", "split").distinct()
    asked = own.join(wanted, ["anchor", "split"]).select("key", "place", "split")
    found = rows.join(asked, ["key", "place"])
    words = F.xxhash64(
        "anchor",
        "split",
        F.substring("left", F.lit(1), F.col("split").cast("int") * WIDTH),
        F.substring("right", F.lit(1), (WINDOW - F.col("split").cast("int")) * WIDTH),
    )
    found = settled(found.select("key", "first", "place", "split", words.alias("words")))
    groups = found.groupBy("words").agg(
        F.min("key").alias("one"), F.max("key").alias("two"),
        F.min("first").alias("least"), F.max("first").alias("most"),
    )
    groups = groups.where("one < two").select("words", "least", "most")
    begin = F.col("place") - F.col("split")
    other = F.when(F.col("least") != F.col("first"), F.col("least")).otherwise(F.col("most"))
    return found.join(groups, "words").select(
        "key", begin.alias("begin"), (begin + WINDOW).alias("end"), other.alias("other")
    )


def passages(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """One row per document and repeated passage: doc_id, begin and end (words, end exclusive),
    n_words, other_doc_id (the smallest id met that has words of the passage too)."""
    survey = grams.surveyed(documents, id_column, text)
    found = settled(grams.classes(survey))
    texts = grams.with_shared_anchors(documents, id_column, text, found)
    rows = settled(grams.sliced(texts, SCHEMA, kept_suffixes))
    matches = None
    for order in ORDERS:
        made = sorted_matches(rows, order)
        matches = made if matches is None else matches.union(made)
    open_windows = settled_splits(rows, matches.where("kind = 2"))
    matches = matches.where("kind = 0").select("key", "begin", "end", "other").union(open_windows)
    ranges = matches.groupBy("key").agg(F.collect_set(F.struct("begin", "end", "other")).alias("r"))
    ranges = map_batches(ranges, "key binary, begin bigint, end bigint, other bigint", joined)

    whole = survey.join(found.where("copies > 1").select("key", "first", "last"), "key")
    whole = whole.select(
        "doc_id",
        F.lit(0).cast("bigint").alias("begin"),
        F.col("n_words").alias("end"),
        F.when(F.col("at") == F.col("first"), F.col("last")).otherwise(F.col("first")).alias(
            "other"
        ),
    )
    single = found.where("copies = 1").select("key", "first").join(ranges, "key")
    parts = single.select(F.col("first").alias("doc_id"), "begin", "end", "other")
    known = F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")).alias("doc_id")
    return whole.union(parts).select(
        known,
        F.col("begin").alias("begin_word"),
        F.col("end").alias("end_word"),
        (F.col("end") - F.col("begin")).alias("n_words"),
        F.when(F.col("other") != LAST_ID, F.col("other")).alias("other_doc_id"),
    )


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping ranges of a text as one, with the smallest id among them."""
    for batch in batches:
        out: list[tuple] = []
        for key, own in zip(
            batch.column("key").to_pylist(), batch.column("r").to_pylist(), strict=True
        ):
            open_range: list | None = None
            for r in sorted(own, key=lambda r: (r["begin"], r["end"], r["other"])):
                if open_range and r["begin"] < open_range[2]:
                    open_range[2] = max(open_range[2], r["end"])
                    open_range[3] = min(open_range[3], r["other"])
                else:
                    if open_range:
                        out.append(tuple(open_range))
                    open_range = [key, r["begin"], r["end"], r["other"]]
            out.append(tuple(open_range))
        if out:
            columns = zip(*out, strict=True)
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(columns, kinds, strict=True)],
                names=["key", "begin", "end", "other"],
            )
