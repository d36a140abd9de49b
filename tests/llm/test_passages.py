"""Repeated passages: suffix arrays and suffix automata against all windows."""

import hashlib
import random
import re

import pytest
from hard_tables import SMALL, empty, hard  # noqa: F401

from lagline.llm import automata, grams, suffixes
from lagline.llm.queries import QUERIES

LAST = float("inf")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def slow_removal(rows):
    first = {}
    for i, text in rows:
        words = words_of(text)
        for a in range(len(words) - 49):
            window = tuple(words[a : a + 50])
            own = LAST if i is None else i
            first[window] = min(first.get(window, own), own)
    out = []
    for i, text in rows:
        words = words_of(text)
        gone = set()
        for a in range(len(words) - 49):
            if first[tuple(words[a : a + 50])] < (LAST if i is None else i):
                gone.update(range(a, a + 50))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((str(i), len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def as_rows(frame):
    return sorted((str(r[0]), *r[1:]) for r in frame.collect())


def id_and_text(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_automaton_against_all_substrings():
    draw = random.Random(3)
    for _ in range(30):
        texts = [[draw.choice("ab") for _ in range(draw.randrange(30))] for _ in range(4)]
        automaton, known = automata.SuffixAutomaton(), set()
        for text in texts:
            lengths = automaton.matches(text)
            for end, length in enumerate(lengths, 1):
                longest = max(n for n in range(end + 1) if "".join(text[end - n : end]) in known
                              or n == 0)
                assert length == longest
            automaton.add(text)
            known |= {"".join(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1)}


@pytest.mark.parametrize("limit", [automata.SHARD_WORDS, 300, 0])
def test_removal_of_hard_texts(hard, monkeypatch, limit):
    monkeypatch.setattr(automata, "SHARD_WORDS", limit)
    assert as_rows(automata.dedup(hard, "doc_id", "text")) == slow_removal(id_and_text(hard))


def test_removal_query(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = as_rows(QUERIES["op6_suffix_automata"](spark, SMALL))
    assert found == slow_removal(id_and_text(documents))


def test_empty_table(empty):
    assert automata.dedup(empty, "doc_id", "text").collect() == []
    assert suffixes.passages(empty, "doc_id", "text").collect() == []


def slow_passages(rows):
    """Words per id in windows that another text, or a copy, has too."""
    holders = {}
    for number, (_, text) in enumerate(rows):
        words = words_of(text)
        for a in range(len(words) - 49):
            holders.setdefault(tuple(words[a : a + 50]), set()).add(number)
    out = {}
    for number, (i, text) in enumerate(rows):
        words = words_of(text)
        for a in range(len(words) - 49):
            if holders[tuple(words[a : a + 50])] - {number}:
                out.setdefault(str(i), set()).update(range(a, a + 50))
    return out


def found_passages(frame):
    out = {}
    for row in frame.collect():
        assert row.n_words == row.end_word - row.begin_word >= 50
        out.setdefault(str(row.doc_id), set()).update(range(row.begin_word, row.end_word))
    return out


def test_passages_of_hard_texts(hard):
    assert found_passages(suffixes.passages(hard, "doc_id", "text")) == slow_passages(
        id_and_text(hard)
    )


def test_passages_query(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = found_passages(QUERIES["op3_suffix_array"](spark, SMALL))
    assert found == slow_passages(id_and_text(documents))


def test_a_passage_that_many_share(spark):
    """One passage in 300 texts, in ranges of a few rows."""
    draw = random.Random(9)

    def fresh(count):
        return [f"w{draw.randrange(10**9)}" for _ in range(count)]

    shared = fresh(60)
    rows = [(i, " ".join(fresh(30) + shared + fresh(30))) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffixes.passages(frame, "doc_id", "text").collect()
    assert sorted((r.doc_id, r.begin_word, r.end_word) for r in found) == [
        (i, 30, 90) for i in range(300)
    ]
    left = automata.dedup(frame, "doc_id", "text").collect()
    assert sorted(r.n_removed for r in left) == [0] + [60] * 299


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_templates_of_headers_and_footers(spark, seed):
    """40 headers x a core x 40 footers: each passage of 54 words is in two texts only, and its
    neighbours in either order are others."""
    draw = random.Random(seed)

    def fresh(count):
        return [f"w{draw.randrange(10**9)}" for _ in range(count)]

    core, heads, feet = fresh(30), [fresh(12) for _ in range(40)], [fresh(12) for _ in range(40)]
    texts = [" ".join(fresh(9) + h + core + f + fresh(9)) for h in heads for f in feet for _ in "ab"]
    draw.shuffle(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = suffixes.passages(frame, "doc_id", "text").collect()
    assert {(r.doc_id, r.begin_word, r.end_word) for r in found} == {
        (i, 9, 63) for i in range(3200)
    }
    partner = {r.doc_id: r.other_doc_id for r in found}
    assert all(partner[partner[i]] == i != partner[i] for i in partner)


@pytest.mark.parametrize("limit", [automata.SHARD_WORDS, 2000])
def test_removal_of_a_core_in_many_contexts(spark, monkeypatch, limit):
    """A shard of stretches that are all different, cut again by longer anchors."""
    monkeypatch.setattr(automata, "SHARD_WORDS", limit)
    draw = random.Random(6)

    def fresh(count):
        return [f"w{draw.randrange(10**9)}" for _ in range(count)]

    core, heads, feet = fresh(30), [fresh(12) for _ in range(12)], [fresh(12) for _ in range(12)]
    texts = [" ".join(fresh(9) + h + core + f + fresh(9)) for h in heads for f in feet for _ in "ab"]
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = as_rows(automata.dedup(frame, "doc_id", "text"))
    assert found == slow_removal(rows)
    assert sum(r[2] > 0 for r in found) == 144


def test_equal_windows_have_equal_anchors():
    draw = random.Random(4)
    words = [str(draw.randrange(50)).encode() for _ in range(400)]
    codes = grams.word_codes(words, grams.WordCodes())
    least, hashes = grams.anchors(codes)
    assert len(least) == 351 and len(hashes) == 376
    assert all(least[a] == hashes[a : a + 26].min() for a in range(351))
    starts, ends = grams.runs(least, 5)
    assert (ends - starts <= 5).all() and ends[-1] == 351 and (starts[1:] == ends[:-1]).all()
