"""Toxic spans by a linear-chain conditional random field; document scores from its marginals.

Learning uses labelled rows whose crc32 of the id (as text) is not 0 modulo 5, from them at most
``SAMPLE_PER_CLASS`` toxic and as many other documents (smallest hashes of their ids). A word is
labelled toxic in a toxic document if its share of toxic documents is far above that of the
others; every other word, and every word of the other documents, is labelled clean. The field is
trained on at most ``SAMPLE_CHAINS`` chains of these documents. Two states, features of the word
and its ends: the score of a word does not depend on where it stands, so it is computed once per
distinct word; forward-backward over the chain then gives each word's probability.

A document's score is a logistic function of the largest probability, of their sum and of their
share, fitted on the same documents. Only the text enters a score. Chains are cut after
``CHAIN`` words. Null and empty texts have no words and get the score of that.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.llm import crf
from lagline.llm.common import map_texts, quoted, settled, smallest_hashes

FOLDS = 5
SAMPLE_PER_CLASS = 3000
SAMPLE_CHAINS = 12_000
MOST_WORDS = 4000
LEAST_DOCUMENTS = 4
LEAST_LIFT = 3.0
CHAIN = 32
BUCKETS = 1 << 16
MOST_CACHED = 300_000

WORD = re.compile(r"[^\W_]+")


def held_out(ids: Column) -> Column:
    """True for the rows whose labels are never learnt from; false for a null id."""
    rest = F.crc32(ids.cast("string").cast("binary")) % FOLDS
    return F.coalesce(rest == 0, F.lit(False))


def word_features(word: str) -> list[int]:
    data = word.encode()
    parts = (b"w" + data, b"p" + data[:4], b"s" + data[-4:], b"n%d" % min(len(data), 12))
    return [zlib.crc32(p) % BUCKETS for p in parts]


@dataclass
class Scorer:
    chain: crf.Chain
    logistic: np.ndarray


class Words(dict):
    """Scores of the two tags for words, computed when first met; emptied when large."""

    def __init__(self, chain: crf.Chain):
        super().__init__()
        self.chain = chain

    def __missing__(self, word: str) -> float:
        if len(self) > MOST_CACHED:
            self.clear()
        pair = self.chain.weights[word_features(word)].sum(axis=0)
        self[word] = value = float(pair[1] - pair[0])
        return value


def probabilities(texts: list[str], words: Words) -> list[np.ndarray]:
    """Per text the probability of the toxic tag for each word."""
    values, counts = [], []
    for text in texts:
        found = WORD.findall(text.lower())
        counts.append(len(found))
        values.append(np.fromiter(map(words.__getitem__, found), np.float32, len(found)))
    rows = [-(-n // CHAIN) for n in counts]
    scores = np.zeros((sum(rows), CHAIN), np.float32)
    lengths = np.full(sum(rows), CHAIN)
    at = 0
    for value, n, used in zip(values, counts, rows, strict=True):
        scores[at : at + used].reshape(-1)[:n] = value
        if used:
            lengths[at + used - 1] = n - CHAIN * (used - 1)
        at += used
    toxic = two_state(scores, lengths, words.chain.steps)
    out, at = [], 0
    for n, used in zip(counts, rows, strict=True):
        out.append(toxic[at : at + used].reshape(-1)[:n])
        at += used
    return out


def two_state(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Forward-backward for two tags: log odds of the words in, probabilities of tag 1 out."""
    if not len(scores):
        return scores
    odds = np.exp(np.clip(scores, -30, 30)).T.copy()
    edge = np.exp(steps)
    most, rows = odds.shape
    forward = np.empty_like(odds)  # tag 1 : tag 0, given all words up to here
    forward[0] = odds[0]
    for t in range(1, most):
        before = forward[t - 1]
        forward[t] = odds[t] * (edge[0, 1] + before * edge[1, 1])
        forward[t] /= edge[0, 0] + before * edge[1, 0]
    backward = np.ones(rows, odds.dtype)  # the same for all words after here
    out = np.empty_like(odds)
    for t in range(most - 1, -1, -1):
        both = forward[t] * backward
        out[t] = both / (1 + both)
        if t:
            inside = lengths > t
            right = odds[t] * backward
            now = (edge[1, 0] + edge[1, 1] * right) / (edge[0, 0] + edge[0, 1] * right)
            backward = np.where(inside, now, 1.0).astype(odds.dtype)
    return out.T


def summary(toxic: np.ndarray) -> list[float]:
    if not len(toxic):
        return [0.0, 0.0, 0.0, 1.0]
    total = float(toxic.sum(dtype=np.float64))
    return [float(toxic.max()), float(np.log1p(total)), 10 * total / len(toxic), 1.0]


def logistic(rows: np.ndarray, labels: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression by Newton steps."""
    weights = np.zeros(rows.shape[1])
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (labels - chance) - 0.1 * weights
        bend = (rows * (chance * (1 - chance))[:, None]).T @ rows + 0.1 * np.eye(len(weights))
        weights = weights + np.linalg.solve(bend, slope)
    return weights


def sample(documents: DataFrame, labels: DataFrame, id_column: str, text: str) -> DataFrame:
    """The labelled documents to learn from, written once: id, toxic, text.

    One text per sampled id, the smallest, so there are at most ``SAMPLE_PER_CLASS`` a class.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1) & F.col("id").isNotNull())
    known = known.where(~held_out(F.col("id")))
    chosen = None
    for value in (1, 0):
        own = known.where(F.col("toxic") == value)
        own = smallest_hashes(own, "id", SAMPLE_PER_CLASS, own.count())
        chosen = own if chosen is None else chosen.union(own)
    chosen = chosen.groupBy("id").agg(F.max("toxic").alias("toxic"))
    rows = documents.select(
        F.col(quoted(id_column)).alias("id"), F.col(quoted(text)).alias("text")
    )
    rows = rows.where("text is not null").join(F.broadcast(chosen), "id")
    once = rows.groupBy("id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    return settled(once)


def toxic_words(rows: DataFrame) -> set[str]:
    """Words whose share of toxic documents is far above that of the others."""
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]+)")))
    words = rows.select("toxic", F.explode(found).alias("word"))
    counts = words.groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")
    )
    sizes = rows.agg(
        F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")
    ).first()
    if not sizes.t:
        return set()
    share_t = (F.col("t") + 0.5) / (sizes.t + 1)
    share_c = (F.col("c") + 0.5) / (sizes.c + 1)
    lift = F.log(share_t / share_c)
    spread = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    strong = counts.where((F.col("t") >= LEAST_DOCUMENTS) & (lift >= LEAST_LIFT * spread))
    strong = strong.where(lift >= 1.0).orderBy(F.desc(lift / spread), "word")
    return {r.word for r in strong.select("word").limit(MOST_WORDS).collect()}


def train(documents: DataFrame, labels: DataFrame, id_column: str, text: str) -> Scorer:
    """The field and the logistic weights; without labelled documents every score is 0.5 or less."""
    rows = sample(documents, labels, id_column, text)
    listed = toxic_words(rows)
    shared = documents.sparkSession.sparkContext.broadcast(listed)

    def start() -> Callable[[list], list]:
        known = shared.value

        def work(texts: list) -> list:
            words, tags = [], []
            for value in texts:
                found = WORD.findall(value.lower())
                words.append([found[i : i + CHAIN] for i in range(0, len(found), CHAIN)])
                tags.append([[int(w in known) for w in chain] for chain in words[-1]])
            return [words, tags]

        return work

    fields = [
        ("words", "array<array<string>>", pa.list_(pa.list_(pa.string()))),
        ("tags", "array<array<int>>", pa.list_(pa.list_(pa.int32()))),
    ]
    made = map_texts(rows, "text", fields, start)
    chains = made.select("id", "toxic", F.posexplode(F.arrays_zip("words", "tags")).alias("n", "c"))
    chains = chains.select("id", "n", "toxic", "c.words", "c.tags")
    chains = chains.withColumn("marked", F.exists("tags", lambda t: t == 1))
    parts = (
        chains.where("marked and toxic = 1"),
        chains.where("marked and toxic = 0"),
        chains.where("not marked"),
    )
    collected = []
    for part in parts:
        ordered = part.orderBy(F.xxhash64("id", "n"), "id", "n").limit(SAMPLE_CHAINS // 3)
        collected += ordered.collect()
    width = 4
    if collected:
        features, lengths = crf.padded(
            [[word_features(w) for w in r.words] for r in collected], width
        )
        gold, _ = crf.padded([r.tags if r.toxic else [0] * len(r.tags) for r in collected])
        chain = crf.train(features, gold, lengths, BUCKETS, 2, rounds=15)
    else:
        chain = crf.Chain(np.zeros((BUCKETS, 2)), np.zeros((2, 2)))
    table = summaries(rows.select("id", "toxic", "text"), "text", chain).collect()
    if not table:
        return Scorer(chain, np.array([1.0, 0.0, 0.0, -1.0]))
    values = np.array([r.summary for r in table])
    return Scorer(chain, logistic(values, np.array([float(r.toxic) for r in table])))


def summaries(rows: DataFrame, text: str, chain: crf.Chain) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(chain.plain())

    def start() -> Callable[[list], list]:
        words = Words(crf.Chain(*shared.value))

        def work(texts: list) -> list:
            return [[summary(p) for p in probabilities([t or "" for t in texts], words)]]

        return work

    return map_texts(rows, text, [("summary", "array<double>", pa.list_(pa.float64()))], start)


def scored(documents: DataFrame, text: str, scorer: Scorer) -> DataFrame:
    """The other columns, with the text replaced by ``score``."""
    shared = documents.sparkSession.sparkContext.broadcast((*scorer.chain.plain(), scorer.logistic))

    def start() -> Callable[[list], list]:
        *chain, weights = shared.value
        words = Words(crf.Chain(*chain))

        def work(texts: list) -> list:
            found = probabilities([t or "" for t in texts], words)
            rows = np.array([summary(p) for p in found]) @ weights
            return [(1 / (1 + np.exp(-np.clip(rows, -30, 30)))).tolist()]

        return work

    return map_texts(documents, text, [("score", "double", pa.float64())], start)


def spans(documents: DataFrame, id_column: str, text: str, scorer: Scorer) -> DataFrame:
    """One row per toxic word: doc_id, begin and end (code points, end exclusive), probability."""
    shared = documents.sparkSession.sparkContext.broadcast((*scorer.chain.plain(), scorer.logistic))

    def start() -> Callable[[list], list]:
        words = Words(crf.Chain(*shared.value[:2]))

        def work(texts: list) -> list:
            out = []
            for value in texts:
                toxic = probabilities([value or ""], words)[0]
                marks = []
                if len(toxic) and toxic.max() >= 0.5:
                    lowered = value.lower()
                    same = lowered if len(lowered) == len(value) else value
                    for p, m in zip(toxic, WORD.finditer(same), strict=False):
                        if p >= 0.5:
                            marks.append({"begin": m.start(), "end": m.end(), "p": float(p)})
                out.append(marks)
            return [out]

        return work

    rows = documents.select(
        F.col(quoted(id_column)).alias("doc_id"), F.col(quoted(text)).alias("text")
    )
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
    sql = "array<struct<begin:bigint,end:bigint,p:double>>"
    made = map_texts(rows, "text", [("spans", sql, kind)], start)
    return made.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")


def score(documents: DataFrame, id_column: str, text: str, scorer: Scorer) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    ids = F.col(quoted(id_column))
    rows = documents.select(
        ids.alias("doc_id"), held_out(ids).alias("held_out"), F.col(quoted(text)).alias("text")
    )
    made = scored(rows, "text", scorer)
    return made.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def accepted(documents: DataFrame, text: str, scorer: Scorer) -> DataFrame:
    """The documents whose score is under 0.5, all columns."""
    copy, mark = "__text", "__score"
    while copy in documents.columns or mark in documents.columns:
        copy, mark = copy + "_", mark + "_"
    rows = documents.withColumn(copy, F.col(quoted(text)))
    made = scored(rows, copy, scorer).withColumnRenamed("score", mark)
    return made.where(F.col(mark) < 0.5).select(*[quoted(c) for c in documents.columns])
