"""Benchmark decontamination: one Aho-Corasick automaton over the normalised test items.

Words are runs of ASCII letters and digits and of any characters beyond ASCII; A-Z count as a-z.
The work is on UTF-8 bytes, where every byte beyond ASCII is part of a word.
The pattern of a window is its words with a blank before, between and after them, so that a
match in the normalised text (made alike) is a match of whole words. A text is scanned once;
word numbers lead back to offsets in the original text.

Nulls and empty texts have no words: nothing is hit. An item without an id (null) hits words
but is not listed. Repeated items count once; repeated documents give repeated rows.

The items are broadcast, and each Python worker builds the automaton once. An item of B bytes makes
at most (B + 2) nodes a word of a window; a benchmark of more than ``most_nodes`` is split, by hashes
of the items, into as many automata as that takes. Each scans all distinct texts in a pass of its
own, and the hits of a text are joined by its content key. One item that alone has more nodes is
not split.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import content_key, map_texts, quoted, settled, unused

#: Most nodes of one automaton. Measured: 54 bytes and 1.1 us a node.
MOST_NODES = 10_000_000

#: Words of the original text, capitals included.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: UTF-8 bytes: A-Z become a-z, other ASCII bytes outside of words become blanks.
FOLD = bytes(
    (i | 32 if chr(i).isalpha() else i) if chr(i).isalnum() else 32 for i in range(128)
) + bytes(range(128, 256))


def normal_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, in lower case as far as A-Z go."""
    return text.encode().translate(FOLD).split() if text else []


def as_line(words: list[bytes]) -> str:
    """One character per byte, as the automaton takes strings."""
    return f" {b' '.join(words).decode('latin-1')} "


def windows(words: list[bytes], size: int) -> set[str]:
    if not words:
        return set()
    last = max(len(words) - size, 0)
    return {as_line(words[i : i + size]) for i in range(last + 1)}


def build(items: Iterable[tuple[int | None, str | None]], size: int) -> ahocorasick.Automaton:
    """An automaton whose value per window is (its number of words, the ids of its items)."""
    holders: dict[str, set] = defaultdict(set)
    for item, text in items:
        for window in windows(normal_words(text), size):
            holders[window].add(item)
    automaton = ahocorasick.Automaton()
    for window, ids in holders.items():
        listed = tuple(sorted(i for i in ids if i is not None))
        automaton.add_word(window, (window.count(" ") - 1, listed))
    automaton.make_automaton()
    return automaton


def find(automaton: ahocorasick.Automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
    """Hit ranges of word numbers (end exclusive, merged) and the items behind them."""
    if not words or not len(automaton):
        return [], set()
    line = as_line(words)
    items: set = set()
    ranges: list[tuple[int, int]] = []
    ends = None
    for at, (count, ids) in automaton.iter(line):
        if ends is None:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        items.update(ids)
        end = int(np.searchsorted(ends, at)) + 1
        begin = end - count
        while ranges and ranges[-1][1] >= begin:
            before, until = ranges.pop()
            begin, end = min(begin, before), max(end, until)
        ranges.append((begin, end))
    return ranges, items


def character_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of word numbers as offsets in the original text."""
    if not ranges:
        return []
    places = [m.span() for m in WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in ranges]


def cut_out(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the spans, blank for each."""
    if not spans:
        return text
    kept, begin = [], 0
    for a, b in spans:
        kept.append(text[begin:a].rstrip())
        begin = b
    kept.append(text[begin:].lstrip())
    return " ".join(x for x in kept if x)


def _parts(items: DataFrame, size: int, most_nodes: int) -> list[DataFrame]:
    """The distinct items in parts of about ``most_nodes`` nodes, split by a hash of the text."""
    items = items.distinct()
    texts = F.sum(F.octet_length("text").cast("bigint") + 2)
    total = size * items.agg(F.coalesce(texts, F.lit(0))).first()[0]
    count = max(1, math.ceil(total / most_nodes))
    if count == 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("text"), F.lit(count)) == k) for k in range(count)]


def _shared(items: DataFrame, size: int) -> Callable[[], ahocorasick.Automaton]:
    """The automaton of the items, for use in tasks. A worker process keeps what it has built
    beside the broadcast items, so its later tasks find it there."""
    rows = [(r[0], r[1]) for r in items.toLocalIterator()]
    shared = items.sparkSession.sparkContext.broadcast({"items": rows})

    def automaton() -> ahocorasick.Automaton:
        own = shared.value
        if "automaton" not in own:
            own["automaton"] = build(own["items"], size)
        return own["automaton"]

    return automaton


def _scan(frame: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """``frame`` with its text replaced by n_words, flat hit ranges and item ids."""
    shared = _shared(items, size)

    def start() -> Callable[[list], list]:
        automaton = shared()

        def work(texts: list) -> list:
            counts, hits, found = [], [], []
            for text in texts:
                words = normal_words(text)
                ranges, ids = find(automaton, words)
                counts.append(len(words))
                hits.append([x for pair in ranges for x in pair])
                found.append(sorted(ids))
            return [counts, hits, found]

        return work

    fields = [
        ("n_words", "bigint", pa.int64()),
        ("hits", "array<int>", pa.list_(pa.int32())),
        ("items", "array<bigint>", pa.list_(pa.int64())),
    ]
    return map_texts(frame, "text", fields, start)


def _merged(hits: list[list[int]]) -> list[tuple[int, int]]:
    pairs = sorted((h[i], h[i + 1]) for h in hits for i in range(0, len(h), 2))
    out: list[tuple[int, int]] = []
    for a, b in pairs:
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def scan(
    documents: DataFrame,
    id_column: str,
    text: str,
    items: DataFrame,
    item_id: str,
    item_text: str,
    window: int = 10,
    most_nodes: int = MOST_NODES,
) -> DataFrame:
    """Per document: doc_id, n_words, hits (flat ranges of word numbers), items (ids)."""
    rows = documents.select(
        F.col(quoted(id_column)).alias("doc_id"), F.col(quoted(text)).alias("text")
    )
    bench = items.select(
        F.col(quoted(item_id)).cast("bigint").alias("item_id"),
        F.col(quoted(item_text)).alias("text"),
    )
    parts = _parts(bench, window, most_nodes)
    if len(parts) == 1:
        return _scan(rows, parts[0], window)
    keyed = rows.withColumn("key", content_key(F.col("text")))
    ids = settled(keyed.select("doc_id", "key"))
    by_text = _scan_in_parts(keyed, parts, window)
    return ids.join(by_text, "key").select("doc_id", "n_words", "hits", "items")


def _scan_in_parts(keyed: DataFrame, parts: list[DataFrame], window: int) -> DataFrame:
    """Per distinct text of ``keyed`` (key, text): key, n_words and the hits and items of all
    parts in the text as it is."""
    distinct = settled(keyed.groupBy("key").agg(F.first("text").alias("text")))
    found = None
    for part in parts:
        made = _scan(distinct, part, window)
        found = made if found is None else found.unionByName(made)

    def start() -> Callable[[list], list]:
        return lambda texts: [[[x for pair in _merged(hits) for x in pair] for hits in texts]]

    by_text = found.groupBy("key").agg(
        F.max("n_words").alias("n_words"),
        F.collect_list("hits").alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return map_texts(by_text, "hits", [("hits", "array<int>", pa.list_(pa.int32()))], start)


def report(found: DataFrame) -> DataFrame:
    """Counts, the digest of the item ids and the verdict for rows of :func:`scan`."""

    hit = F.expr(
        "cast(aggregate(sequence(0, size(hits) - 1, 2), 0, "
        "(s, i) -> s + hits[i + 1] - hits[i]) as bigint)"
    )
    counted = found.select(
        "doc_id",
        "n_words",
        F.when(F.size("hits") > 0, hit).otherwise(F.lit(0)).cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(
            F.array_join(F.array_sort(F.col("items").cast("array<string>")), ","), 256
        ).alias("items_sha256"),
    )
    return counted.withColumn("contaminated", F.col("n_hit") > 0)


def clean(
    documents: DataFrame, text: str, items: DataFrame, item_id: str, item_text: str,
    window: int = 10, most_nodes: int = MOST_NODES,
) -> DataFrame:
    """The documents with every passage of an item cut out of the text; no row goes.

    All columns stay. A text without a hit stays as it is, a null stays null. All items are
    looked for in the text as it was, in however many parts, before anything is cut.
    """
    bench = items.select(
        F.col(quoted(item_id)).cast("bigint").alias("item_id"),
        F.col(quoted(item_text)).alias("text"),
    )
    parts = _parts(bench, window, most_nodes)
    if len(parts) == 1:
        return _cut(documents, text, parts[0], window)
    content = F.col(quoted(text))
    keyed = documents.select(content_key(content).alias("key"), content.alias("text"))
    by_text = _scan_in_parts(keyed, parts, window).where(F.size("hits") > 0)
    key, hits = unused(documents, "key"), unused(documents, "hits")
    by_text = by_text.select(F.col("key").alias(key), F.col("hits").alias(hits))

    def start() -> Callable[[list], list]:
        def without(value: str | None, own: list[int] | None) -> str | None:
            if not own:
                return value
            return cut_out(value, character_spans(value, list(zip(own[::2], own[1::2], strict=True))))

        return lambda rows: [[without(r["text"], r["hits"]) for r in rows]]

    joined = documents.withColumn(key, content_key(content)).join(by_text, key, "left")
    both = F.struct(content.alias("text"), F.col(hits).alias("hits"))
    joined = joined.withColumn(text, both).drop(key, hits)
    made = map_texts(joined, text, [(text, "string", pa.string())], start)
    return made.select(*[quoted(c) for c in documents.columns])


def _cut(frame: DataFrame, text: str, items: DataFrame, size: int) -> DataFrame:
    shared = _shared(items, size)

    def start() -> Callable[[list], list]:
        automaton = shared()

        def work(texts: list) -> list:
            out = []
            for value in texts:
                ranges, _ = find(automaton, normal_words(value))
                out.append(cut_out(value, character_spans(value, ranges)) if ranges else value)
            return [out]

        return work

    made = map_texts(frame, text, [(text, "string", pa.string())], start)
    return made.select(*[quoted(c) for c in frame.columns])
