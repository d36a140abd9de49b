import hashlib
import random
import re

import pytest
from hard_tables import SMALL, empty, hard  # noqa: F401

from lagline.llm import decontamination
from lagline.llm.queries import QUERIES


def words_of(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def slow(documents, items, size=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        for a in range(max(len(words) - size, 0) + 1 if words else 0):
            windows.setdefault(tuple(words[a : a + size]), set()).add(item)
    out = []
    for i, text in documents:
        words, hit, found = words_of(text), set(), set()
        for length in {len(w) for w in windows}:
            for a in range(len(words) - length + 1):
                own = windows.get(tuple(words[a : a + length]))
                if own:
                    hit.update(range(a, a + length))
                    found |= own
        line = ",".join(sorted(str(x) for x in found if x is not None))
        digest = hashlib.sha256(line.encode()).hexdigest()
        count = len([x for x in found if x is not None])
        out.append((str(i), len(words), len(hit), count, digest, bool(hit)))
    return sorted(out)


ITEMS = [
    (2, "Epsilon ONE"),
    (10, "one"),
    (1, "one"),
    (1, "one"),
    (None, "Same same"),
    (3, None),
    (4, " .. "),
    (5, "déjà 漢字 x1 " * 6),
    (6, "b\x85c\xa0d 😀"),
]
TEXTS = [
    (100, "Zero one, two; " + "Déjà 漢字-x1 " * 4),
    (101, "déjà! 漢字? X1. " * 7 + "end"),
    (102, "ones one1 oneone"),
]


def tables(spark, hard):
    documents = [(r.doc_id, r.text) for r in hard.collect()] + TEXTS
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    return documents, frame, spark.createDataFrame(ITEMS, "item_id long, text string")


def as_rows(frame):
    return sorted((str(r[0]), *r[1:]) for r in frame.collect())


@pytest.mark.parametrize("most", [decontamination.MOST_NODES, 600])
def test_hard_texts(spark, hard, most):  # noqa: F811
    documents, frame, items = tables(spark, hard)
    found = decontamination.scan(frame, "doc_id", "text", items, "item_id", "text", 10, most)
    assert as_rows(decontamination.report(found)) == slow(documents, ITEMS)


@pytest.mark.parametrize("most", [decontamination.MOST_NODES, 600])
def test_clean_removes_all_hits_and_nothing_else(spark, hard, most):  # noqa: F811
    documents, frame, items = tables(spark, hard)
    left = decontamination.clean(frame, "text", items, "item_id", "text", 10, most).collect()
    hits = {r[0]: r[2] for r in slow(documents, ITEMS)}
    before = {str(i): t for i, t in documents}
    assert len(left) == len(documents)
    for row in left:
        if not hits[str(row.doc_id)] and row.doc_id is not None:
            assert row.text == before[str(row.doc_id)]
        elif row.doc_id is not None:
            kept = len(words_of(row.text))
            assert kept == len(words_of(before[str(row.doc_id)])) - hits[str(row.doc_id)]


def test_no_items_and_no_documents(spark, hard, empty):  # noqa: F811
    items = spark.createDataFrame([], "item_id long, text string")
    found = decontamination.scan(hard, "doc_id", "text", items, "item_id", "text")
    assert found.where("size(hits) > 0").count() == 0 and found.count() == hard.count()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.scan(empty, "doc_id", "text", items, "item_id", "text").count() == 0


def test_query(spark):
    read = lambda name: [tuple(r)[:2] for r in spark.read.parquet(f"{SMALL}/{name}.parquet").collect()]
    found = as_rows(QUERIES["op7_decontamination"](spark, SMALL))
    assert found == slow(read("documents"), read("benchmark"))
    assert any(r[-1] for r in found)


@pytest.mark.parametrize("most", [decontamination.MOST_NODES, 300])
def test_overlapping_items_in_several_parts(spark, most):
    """A stem with many answers, and items whose windows only meet in the cut text."""
    stem = " ".join(f"stem{i}" for i in range(12))
    items = [(i, f"{stem} answer{i} last{i}") for i in range(8)]
    items += [(20, "left right"), (21, "cut me")]
    documents = [(i, f"Begin, {stem} answer{i} last{i}; end") for i in range(8)]
    documents += [(30, "left cut me right"), (31, None), (32, "Nothing, here."), (33, "")]
    schema = "item_id long, text string, `Key` string, hits string, `key_` int, __key int"
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame([(i, t, "k", "h", 1, 2) for i, t in documents], schema)
    left = decontamination.clean(frame, "text", bench, "item_id", "text", 10, most)
    assert left.columns == frame.columns
    wanted = [(i, "Begin, ; end", "k", "h", 1, 2) for i in range(8)]
    wanted += [(30, "left right", "k", "h", 1, 2), (31, None, "k", "h", 1, 2)]
    wanted += [(32, "Nothing, here.", "k", "h", 1, 2), (33, "", "k", "h", 1, 2)]
    assert sorted(map(tuple, left.collect())) == wanted


def test_the_limit_counts_no_fewer_nodes_than_there_are(spark):
    draw = random.Random(5)
    items = [(i, " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))) for i, n in
             enumerate([1, 3, 9, 10, 11, 60, 400])]
    built = decontamination.build(items, 10)
    assert built.get_stats()["nodes_count"] <= 10 * sum(len(t) + 2 for _, t in items) + 1
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert len(decontamination._parts(bench, 10, 1 << 30)) == 1
    parts = decontamination._parts(bench, 10, 10_000)
    assert len(parts) > 1 and sum(p.count() for p in parts) == len(items)
