import zlib

import numpy as np
import pytest
from hard_tables import SMALL, empty, hard  # noqa: F401

from lagline.llm import crf, toxicity
from lagline.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scorer(spark):
    read = spark.read.parquet
    return toxicity.train(
        read(f"{MIDDLE}/documents.parquet"), read(f"{MIDDLE}/labels.parquet"), "doc_id", "text"
    )


def test_held_out_accuracy(spark):
    rows = QUERIES["op9_toxicity"](spark, LARGE).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    assert len(rows) == 10_000
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)
    own = [r for r in rows if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in own)
    assert len(own) > 500 and right / len(own) >= 0.97


def test_hard_texts(hard, scorer):  # noqa: F811
    rows = toxicity.score(hard, "doc_id", "text", scorer).collect()
    assert len(rows) == hard.count()
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert not [r for r in rows if r.doc_id is None and r.held_out]
    kept = toxicity.accepted(hard, "text", scorer)
    assert kept.columns == hard.columns


def test_only_the_text_enters_a_score(spark, scorer):
    rows = [(i, "you stupid idiot and moron of a clown") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = toxicity.score(frame, "doc_id", "text", scorer).collect()
    assert len({r.score for r in found}) == 1 and found[0].predicted == 1


def test_spans_are_offsets_of_toxic_words(spark, scorer):
    text = "The an of, idiot! the was MORON the"
    frame = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    found = toxicity.spans(frame, "doc_id", "text", scorer).collect()
    assert sorted(text[r.begin : r.end] for r in found) == ["MORON", "idiot"]


def test_labels_of_held_out_rows_are_not_learnt(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, toxic int")
    rows = toxicity.sample(documents, labels, "doc_id", "text").collect()
    assert rows and all(zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def test_no_labels_and_no_documents(spark, hard, empty):  # noqa: F811
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    untaught = toxicity.train(hard, labels, "doc_id", "text")
    assert {r.predicted for r in toxicity.score(hard, "doc_id", "text", untaught).collect()} == {0}
    assert toxicity.score(empty, "doc_id", "text", untaught).collect() == []


def test_two_states_like_the_general_chain():
    draw = np.random.default_rng(2)
    scores = draw.normal(size=(6, 8)).astype(np.float32)
    lengths = np.array([8, 8, 3, 1, 8, 5])
    steps = draw.normal(size=(2, 2))
    both = np.stack([np.zeros_like(scores), scores], axis=2)
    expected, _ = crf.marginals(both, lengths, steps)
    found = toxicity.two_state(scores, lengths, steps)
    for i, n in enumerate(lengths.tolist()):
        assert np.allclose(found[i, :n], expected[i, :n, 1], atol=1e-5)
