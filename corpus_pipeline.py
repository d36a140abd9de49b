"""The corpus pipeline: toxicity, near-duplicates, decontamination, personal data, tokens.

Each stage takes (spark, docs, folder) and returns what the next one reads. All but the last
return the columns of the documents; the last adds ``n_tokens`` and ``tokens``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lagline.llm import bpe, decontamination, personal, simhash, toxicity
from lagline.llm.common import settled, table


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Only documents with a toxicity score under 0.5 stay."""
    scorer = toxicity.train(docs, table(spark, folder, "labels"), "doc_id", "text")
    return toxicity.accepted(docs, "text", scorer)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near-duplicates (five words, similarity 0.8) one document stays."""
    return simhash.one_of_each(docs, "doc_id", "text", 5, 0.8)


def remove_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts."""
    items = table(spark, folder, "benchmark")
    return decontamination.clean(docs, "text", items, "item_id", "text")


def redact_personal(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return personal.redact(docs, "text", personal.train_field(docs, "doc_id", "text"))


def tokenise(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of the texts."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(docs, "text", ranks, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", remove_benchmark),
    ("personal_data", redact_personal),
    ("byte_bpe", tokenise),
]

#: No SQL: the classifiers and the tokenizer cannot be expressed in it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = settled(docs)
    return docs
