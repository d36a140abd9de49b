"""Word windows of whole texts, and the anchors by which equal windows find each other.

Words are runs of bytes between blanks (space, tab to carriage return). A window is ``WINDOW``
consecutive words; its anchor is the smallest hash of the ``GRAM``-word runs in it. Equal windows
have equal anchors, and neighbouring windows mostly share theirs, so a text has far fewer
anchors than words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import content_key, map_batches, map_texts, quoted, settled

WINDOW = 50
GRAM = 25
SPAN = WINDOW - GRAM + 1
MOST_CACHED = 300_000
#: Odd bases of the running sums, and their inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
LAST_ID = (1 << 63) - 1


class WordCodes(dict):
    """64 bits per word, computed when first met; emptied when large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MOST_CACHED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def split_words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def word_codes(words: list[bytes], known: WordCodes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def run_hashes(codes: np.ndarray, size: int, base: int = BASES[0]) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    if len(codes) < size:
        return np.zeros(0, np.uint64)
    count = len(codes)
    powers = np.full(count, base, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    back = np.full(count - size + 1, pow(base, -1, 1 << 64), np.uint64)
    back[0] = 1
    back = np.cumprod(back, dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * powers, dtype=np.uint64)))
    value = (sums[size:] - sums[:-size]) * back
    value ^= value >> np.uint64(31)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    return value


def anchors(codes: np.ndarray, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Per window its anchor; per run of words its hash (the anchors are minima of these)."""
    hashes, span = run_hashes(codes, gram), WINDOW - gram + 1
    if len(hashes) < span:
        return np.zeros(0, np.uint64), hashes
    least, width = hashes, 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least, hashes


def runs(least: np.ndarray, most: int = 4 * SPAN) -> tuple[np.ndarray, np.ndarray]:
    """First windows and ends of runs of windows with one anchor, of ``most`` windows at most."""
    change = np.flatnonzero(least[1:] != least[:-1]) + 1
    starts = np.concatenate(([0], change))
    ends = np.append(change, len(least))
    long = np.flatnonzero(ends - starts > most)
    if len(long):
        more = [np.arange(starts[i], ends[i], most) for i in long.tolist()]
        starts = np.unique(np.concatenate([starts, *more]))
        ends = np.append(starts[1:], len(least))
    return starts, ends


def as_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def surveyed(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """Written once per job: doc_id, at (the id in order, null last), key (content), n_words,
    words_sha256 (words joined by one blank) and the distinct anchors of each text."""

    def start() -> Callable[[list], list]:
        known = WordCodes()

        def work(texts: list) -> list:
            counts, digests, found = [], [], []
            for value in texts:
                words = split_words(value)
                counts.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                least, _ = anchors(word_codes(words, known))
                found.append(as_long(np.unique(least)))
            return [counts, digests, found]

        return work

    fields = [
        ("n_words", "bigint", pa.int64()),
        ("words_sha256", "string", pa.string()),
        ("anchors", "array<bigint>", pa.list_(pa.int64())),
    ]
    return settled(map_texts(keyed(documents, id_column, text), "text", fields, start))


def keyed(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    ids = F.col(quoted(id_column)).cast("bigint")
    return documents.select(
        ids.alias("doc_id"),
        F.coalesce(ids, F.lit(LAST_ID)).alias("at"),
        content_key(F.col(quoted(text))).alias("key"),
        F.col(quoted(text)).alias("text"),
    )


def classes(survey: DataFrame) -> DataFrame:
    """One row per distinct text of a window or more: key, first (smallest id in order), last,
    copies, anchors."""
    own = survey.where(F.col("n_words") >= WINDOW)
    return own.groupBy("key").agg(
        F.min("at").alias("first"),
        F.max("at").alias("last"),
        F.count("*").alias("copies"),
        F.first("anchors").alias("anchors"),
    )


def with_shared_anchors(
    documents: DataFrame, id_column: str, text: str, found: DataFrame
) -> DataFrame:
    """The texts of the first documents of classes that share an anchor with another class:
    key, first, text, shared (those anchors). Written once."""
    every = found.select(
        F.xxhash64("key").alias("class"), F.explode("anchors").alias("anchor")
    )
    shared = every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    wanted = every.join(shared, "anchor").groupBy("class")
    wanted = wanted.agg(F.collect_list("anchor").alias("shared"))
    chosen = found.select("key", "first", F.xxhash64("key").alias("class"))
    chosen = chosen.join(wanted, "class").select("key", "first", "shared")
    texts = keyed(documents, id_column, text).select("key", "at", "text")
    joined = texts.join(chosen, "key").where(F.col("at") == F.col("first"))
    return settled(joined.select("key", "first", "text", "shared"))


def sliced(
    texts: DataFrame, schema: str, work: Callable[[WordCodes, str, np.ndarray], list]
) -> DataFrame:
    """Rows made from each text and its shared anchors: ``work`` returns tuples of the columns
    after key and first."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordCodes()
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                rows = []
                columns = [part.column(c).to_pylist() for c in ("key", "first", "text")]
                shared = part.column("shared").to_pylist()
                for key, own, text, wanted in zip(*columns, shared, strict=True):
                    marks = np.array(wanted, np.int64).view(np.uint64)
                    rows += [(key, own, *row) for row in work(known, text, marks)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(v, k)
                            for v, k in zip(zip(*rows, strict=True), kinds, strict=True)
                        ],
                        names=names,
                    )

    kinds = [_kind(part.split(" ", 1)[1]) for part in schema.split(", ")]
    return map_batches(texts, schema, run)


def _kind(sql: str) -> pa.DataType:
    return {
        "binary": pa.binary(),
        "bigint": pa.int64(),
        "int": pa.int32(),
        "array<bigint>": pa.list_(pa.int64()),
    }[sql]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges (end exclusive) that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
