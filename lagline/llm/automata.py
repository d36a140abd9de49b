"""Substring dedup with suffix automata.

A word goes if a window of ``WINDOW`` words around it also occurs in a document with a smaller id.

Reference shards. Equal windows have equal anchors (see ``grams``), so the documents' stretches of
words with one anchor make a shard of their own: whatever may match a stretch is in it. Equal
stretches are one first, with the smallest id that has them: every other document loses them
whole. The distinct ones of a shard come in the order of ids. Each is first run through the suffix
automaton of those before it, whose matching statistics (the longest match that ends at each
word) give the maximal spans of a window or more; then the automaton takes it in, unless it holds
it already. Anchors that only one text has make no shard. Automata of the whole corpus cannot be
broadcast (the README has figures), so shards are dealt to tasks instead.

A shard of over ``SHARD_WORDS`` distinct words is too large for one task. Its stretches are cut
again by anchors of longer runs of words (``LEVELS``), which makes smaller shards of the same kind.
The last level's anchors are whole windows, whose shards hold one stretch each.

Copies of a text are handled once per text. Null ids count as larger than all others; documents
of the same id do not clear each other. Null and empty texts have no words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm import grams
from lagline.llm.common import map_batches, settled
from lagline.llm.grams import GRAM, WINDOW

#: Most words of a shard whose automaton one task builds.
SHARD_WORDS = 100_000
#: Words of the runs whose hashes are anchors, by level.
LEVELS = (GRAM, 38, 44, 47, WINDOW)
#: Stretches that more than this part of all rows have are looked up by broadcast: at most so many.
HOT_PARTS = 1000
EMPTY = hashlib.sha256(b"").hexdigest()


class SuffixAutomaton:
    """All substrings of the sequences taken in so far, none across two sequences."""

    def __init__(self):
        self.after: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, after: dict) -> int:
        self.after.append(after)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _at_length(self, before: int, state: int, word) -> int:
        """The state of exactly one word more than ``before``, split off ``state`` if need be."""
        size = self.length[before] + 1
        if self.length[state] == size:
            return state
        split = self._state(size, self.link[state], dict(self.after[state]))
        self.link[state] = split
        while before >= 0 and self.after[before].get(word) == state:
            self.after[before][word] = split
            before = self.link[before]
        return split

    def add(self, words: list) -> None:
        last = 0
        for word in words:
            known = self.after[last].get(word)
            if known is not None:
                last = self._at_length(last, known, word)
                continue
            fresh = self._state(self.length[last] + 1, 0, {})
            at = last
            while at >= 0 and word not in self.after[at]:
                self.after[at][word] = fresh
                at = self.link[at]
            if at >= 0:
                self.link[fresh] = self._at_length(at, self.after[at][word], word)
            last = fresh

    def matches(self, words: list) -> list[int]:
        """Per word the length of the longest known substring that ends with it."""
        out, at, size = [], 0, 0
        for word in words:
            while at and word not in self.after[at]:
                at = self.link[at]
                size = self.length[at]
            nxt = self.after[at].get(word)
            if nxt is None:
                at, size = 0, 0
            else:
                at, size = nxt, size + 1
            out.append(size)
        return out


def repeated(lengths: list[int], least: int = WINDOW) -> list[tuple[int, int]]:
    """The spans of words inside matches of ``least`` words or more."""
    return grams.merged([(i + 1 - n, i + 1) for i, n in enumerate(lengths) if n >= least])


def pieces(codes: np.ndarray, level: int, shared: np.ndarray | None = None) -> list[tuple]:
    """(anchor, place of the first word, digest of the words, words) of the runs of windows with
    one anchor, of all or of the ``shared`` ones."""
    least, _ = grams.anchors(codes, LEVELS[level])
    starts, ends = grams.runs(least)
    if shared is not None:
        wanted = np.isin(least[starts], shared)
        starts, ends = starts[wanted], ends[wanted]
    values = grams.as_long(codes)
    out = []
    for anchor, a, b in zip(
        grams.as_long(least[starts]).tolist(), starts.tolist(), ends.tolist(), strict=True
    ):
        own = values[a : b + WINDOW - 1]
        out.append((anchor, a, hashlib.blake2b(own.tobytes(), digest_size=16).digest(), own))
    return out


def stretches(known: grams.WordCodes, text: str, shared: np.ndarray) -> list[tuple]:
    return pieces(grams.word_codes(grams.split_words(text), known), 0, shared)


def spans(parts: DataFrame, level: int = 0) -> DataFrame:
    """key, begin, end of the words to remove, from the settled stretches (key, first, anchor,
    begin, same, words), where ``same`` is a digest of the words."""
    own = settled(
        parts.groupBy("same").agg(
            F.first("anchor").alias("anchor"),
            F.min("first").alias("first"),
            F.count("*").alias("n"),
            F.first("words").alias("words"),
        )
    )
    if level + 1 == len(LEVELS):
        found = by_automata(own)
    else:
        sizes = own.groupBy("anchor").agg(F.sum(F.size("words")).alias("n_words"))
        large = settled(sizes.where(F.col("n_words") > SHARD_WORDS).select("anchor"))
        if large.isEmpty():
            found = by_automata(own)
        else:
            found = by_automata(own.join(large, "anchor", "left_anti"))
            smaller = settled(cut_again(own.join(large, "anchor", "left_semi"), level + 1))
            found = found.union(spans(smaller, level + 1))
    return settled(of_all(parts, own, found))


def cut_again(own: DataFrame, level: int) -> DataFrame:
    """Distinct stretches as stretches by the anchors of ``level``; their key is their digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = zip(*[part.column(i).to_pylist() for i in range(3)], strict=True)
                made = [
                    (key, first, *piece)
                    for key, first, words in rows
                    for piece in pieces(np.array(words, np.int64).view(np.uint64), level)
                ]
                columns = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], names=names
                )

    names = ["key", "first", "anchor", "begin", "same", "words"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    schema = (
        "key binary, first bigint, anchor bigint, begin bigint, same binary, words array<bigint>"
    )
    return map_batches(own.select("same", "first", "words"), schema, run)


def by_automata(own: DataFrame) -> DataFrame:
    """key (the digest), begin, end of what earlier ids have, from distinct stretches."""
    dealt = own.select("anchor", "first", "same", "words")
    dealt = dealt.repartition("anchor").sortWithinPartitions("anchor", "first", "same")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor = owner = automaton = None
        waiting: list[list] = []
        for batch in batches:
            found = []
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = zip(*[part.column(i).to_pylist() for i in range(4)], strict=True)
                for shard, first, same, words in rows:
                    if shard != anchor:
                        anchor, owner, automaton, waiting = shard, first, SuffixAutomaton(), []
                    elif first != owner:
                        for own in waiting:
                            automaton.add(own)
                        owner, waiting = first, []
                    lengths = automaton.matches(words)
                    found += [(same, a, b) for a, b in repeated(lengths)]
                    if lengths[-1] < len(words):
                        waiting.append(words)
            if found:
                keys, begins, ends = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(begins, pa.int64()),
                     pa.array(ends, pa.int64())],
                    names=["key", "begin", "end"],
                )

    return map_batches(dealt, "key binary, begin bigint, end bigint", run)


def of_all(parts: DataFrame, own: DataFrame, found: DataFrame) -> DataFrame:
    """Spans of all stretches from those of the distinct ones.

    A stretch that a smaller id has goes whole. Stretches with more than one row in ``HOT_PARTS``
    are at most so many and need no shuffle.
    """
    ranges = found.groupBy(F.col("key").alias("same")).agg(
        F.collect_list(F.struct("begin", "end")).alias("ranges")  # of one stretch: a few
    )
    rows = parts.select("key", "first", "begin", "same", F.size("words").alias("size"))
    least = own.select("same", F.col("first").alias("least"), "n").join(ranges, "same", "left")
    least = settled(least)
    hot = least.where(F.col("n") * HOT_PARTS > parts.count()).drop("n")
    joined = rows.join(F.broadcast(hot), "same").unionByName(
        rows.join(F.broadcast(hot), "same", "left_anti").join(least.drop("n"), "same")
    )
    whole = F.array(
        F.struct(F.lit(0).cast("bigint").alias("begin"), F.col("size").cast("bigint").alias("end"))
    )
    gone = F.when(F.col("first") > F.col("least"), whole).otherwise(F.col("ranges"))
    cut = joined.select("key", F.col("begin").alias("at"), F.inline(gone))
    return cut.select(
        "key", (F.col("at") + F.col("begin")).alias("begin"), (F.col("at") + F.col("end")).alias("end")
    )


def remaining(texts: DataFrame, found: DataFrame) -> DataFrame:
    """key, n_removed, kept (the words that stay, joined by one blank) of texts with spans."""
    ranges = found.groupBy("key").agg(
        F.collect_list(F.struct(F.col("begin"), F.col("end"))).alias("spans")
    )
    rows = texts.select("key", "text").join(ranges, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                counts, kept = [], []
                for text, own in zip(
                    part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True
                ):
                    words = grams.split_words(text)
                    left, begin, gone = [], 0, 0
                    for a, b in grams.merged([(s["begin"], s["end"]) for s in own]):
                        left += words[begin:a]
                        begin, gone = b, gone + b - a
                    kept.append(b" ".join(left + words[begin:]).decode())
                    counts.append(gone)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(counts, pa.int64()), pa.array(kept)],
                    names=["key", "n_removed", "kept"],
                )

    return map_batches(rows, "key binary, n_removed bigint, kept string", run)


def dedup(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    survey = grams.surveyed(documents, id_column, text)
    found = settled(grams.classes(survey))
    texts = grams.with_shared_anchors(documents, id_column, text, found)
    schema = (
        "key binary, first bigint, anchor bigint, begin bigint, same binary, words array<bigint>"
    )
    parts = settled(grams.sliced(texts, schema, stretches))
    cut = remaining(texts, spans(parts)).select(
        "key", F.col("n_removed").alias("own"), F.sha2("kept", 256).alias("own_sha256")
    )
    cut = cut.groupBy("key").agg(F.first("own").alias("own"), F.first("own_sha256").alias("sha"))
    by_text = found.select("key", "first").join(cut, "key", "left")
    copy = F.col("at") > F.col("first")
    return (
        survey.select("doc_id", "at", "key", "n_words", "words_sha256")
        .join(by_text, "key", "left")
        .select(
            "doc_id",
            "n_words",
            F.when(copy, F.col("n_words")).otherwise(F.coalesce("own", F.lit(0))).alias(
                "n_removed"
            ),
            F.when(copy, F.lit(EMPTY)).otherwise(F.coalesce("sha", "words_sha256")).alias(
                "kept_sha256"
            ),
        )
    )
