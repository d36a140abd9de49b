import re

import numpy as np
import pytest
import xxhash
from hard_tables import SMALL, empty, hard  # noqa: F401

from lagline.llm import simhash
from lagline.llm.components import components
from lagline.llm.queries import QUERIES


def slow_print(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_links(rows, radius=2):
    """(id, fingerprint, component) by comparing all pairs."""
    prints = sorted({p for _, p in rows})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for i, p in rows:
        if i is not None:
            least[find(p)] = min(i, least.get(find(p), i))
    return sorted((str(i), format(p, "016x"), str(least.get(find(p)))) for i, p in rows)


def as_rows(frame):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in frame.collect())


def test_hard_texts(hard):
    rows = [(r.doc_id, slow_print(r.text)) for r in hard.collect()]
    assert as_rows(simhash.linked(hard, "doc_id", "text", 3, 2)) == slow_links(rows)


def test_empty_table(empty):
    assert simhash.linked(empty, "doc_id", "text", 3, 2).collect() == []


def test_query(spark):
    rows = [
        (r.doc_id, slow_print(r.text))
        for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    ]
    assert as_rows(QUERIES["op2_simhash"](spark, SMALL)) == slow_links(rows)


@pytest.mark.parametrize("most", [8, 2048])
def test_all_links_are_found_in_tiles_too(spark, monkeypatch, most):
    draw = np.random.default_rng(5)
    centres = draw.integers(0, 1 << 63, 12, dtype=np.uint64)
    values = {int(c) for c in centres}
    for c in centres:
        for _ in range(40):
            flips = draw.choice(64, draw.integers(1, 5), replace=False)
            values.add(int(c) ^ sum(1 << int(b) for b in flips))
    values |= {(1 << 64) - 1, 0, 1, 1 << 63}
    monkeypatch.setattr(simhash, "TILE", most)
    monkeypatch.setattr(simhash.tiled, "__defaults__", (most,))
    frame = spark.createDataFrame([(simhash.signed(v),) for v in values], "print long")
    roots = components(simhash.near(frame, 2), "a", "b").collect()
    found = {r.node % (1 << 64): r.root for r in roots}
    groups = {}
    for value in values:
        groups.setdefault(found.get(value, value), set()).add(value)
    expected = {}
    for row in slow_links([(v, v) for v in values]):
        expected.setdefault(row[2], set()).add(int(row[0]))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 7, 20])
def test_bit_planes_count_like_popcount(radius):
    draw = np.random.default_rng(radius)
    lanes = draw.integers(0, 1 << 63, (130, 2), dtype=np.uint64)
    lanes[1:60] = lanes[0] ^ draw.integers(0, 256, (59, 2), dtype=np.uint64)
    over = simhash.beyond(lanes, lanes[10:75], radius, 10)
    bits = np.unpackbits(over.view(np.uint8), axis=1, bitorder="little")[:, :130].astype(bool)
    apart = np.bitwise_count(lanes[10:75, None] ^ lanes[None]).sum(axis=2)
    expected = apart > radius
    expected[np.arange(65), np.arange(10, 75)] = True
    assert (bits == expected).all()


def test_carry_save_counts():
    words = np.random.default_rng(1).integers(0, 1 << 63, (1001, 3), dtype=np.uint64)
    bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")
    assert (simhash.bit_counts(words) == bits.sum(axis=0)).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)]
    links += [(200, 200), (None, 5), (7, 3), (7, 3)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.node: r.root for r in found} == {
        **{i: 0 for i in range(41)},
        **{i: 100 for i in range(100, 130)},
    }
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_one_of_each_group_stays(hard):
    kept = simhash.one_of_each(hard, "doc_id", "text")
    assert kept.columns == hard.columns
    rows = kept.select("doc_id", "text").collect()
    ids = [r.doc_id for r in rows]
    # 8 to 10 are copies of 7 but for a word or for case; null and empty texts are equal.
    assert not {2, 8, 9, 10} & set(ids) and {7, 1, 3} <= set(ids)
    # One text without an id is, but for five words, the text of 11.
    assert {0, 4, 5, 6, 11, 12, 14, 15, 16} <= set(ids) and ids.count(None) == 1
    # "same same ..." is one shingle, however often.
    assert 13 not in ids and len(rows) == len(set(rows))


def test_repeated_rows_leave_one(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "d e"), (None, "d e"), (2, "A b  c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(simhash.one_of_each(frame, "doc_id", "text").collect(), key=str) == [
        (1, "a b c"),
        (None, "d e"),
    ]


def test_columns_named_like_helpers_stay(spark):
    rows = [(1, "a b c d", 5, 6, 7, 8), (2, "a b c d", 6, 7, 8, 9), (2, "a b c d", 6, 7, 8, 9)]
    schema = "doc_id long, text string, __key int, __n int, KEY int, least int"
    frame = spark.createDataFrame(rows, schema)
    kept = simhash.one_of_each(frame, "doc_id", "text", 5, 0.8)
    assert kept.columns == frame.columns and list(map(tuple, kept.collect())) == rows[:1]


def test_no_documents(empty):
    assert simhash.one_of_each(empty, "doc_id", "text").collect() == []


def test_groups_agree_with_exact_similarity(spark):
    """Pairs at 0.85 or more go, pairs under 0.6 stay."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = {r.doc_id for r in simhash.one_of_each(documents, "doc_id", "text").collect()}
    sets = {}
    for row in documents.collect():
        words = (row.text or "").encode().lower().split()
        sets[row.doc_id] = {b" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}
    holders = {}
    for i, own in sets.items():
        for shingle in own:
            holders.setdefault(shingle, []).append(i)
    alike = {}
    for ids in holders.values():
        for a in ids:
            for b in ids:
                if a < b:
                    alike[a, b] = alike.get((a, b), 0) + 1
    near = set()
    for (a, b), both in alike.items():
        similarity = both / (len(sets[a]) + len(sets[b]) - both)
        if similarity >= 0.85:
            assert not {a, b} <= kept
        if similarity >= 0.6:
            near |= {a, b}
    assert set(sets) - kept <= near


def brute_force_kept(rows, similarity=0.8):
    """The smallest id of each group of texts of that Jaccard similarity, by all pairs."""
    sets, holders = {}, {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {b" ".join(words[k : k + 5]) for k in range(max(len(words) - 4, 1))}
        for shingle in sets[i]:
            holders.setdefault(shingle, []).append(i)
    alike = {}
    for ids in holders.values():
        for a in ids:
            for b in ids:
                if a < b:
                    alike[a, b] = alike.get((a, b), 0) + 1
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), both in alike.items():
        if both / (len(sets[a]) + len(sets[b]) - both) >= similarity:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return sorted(i for i in sets if root[i] == i)


def texts_at_the_limit():
    """Pairs whose sets of five-word shingles share ``both``, with own ones on each side."""
    draw = np.random.default_rng(8)

    def fresh(count):
        return [f"w{n}" for n in draw.integers(0, 1 << 60, count)]

    rows = []
    # 0.8 or a little more, and a little less: both, own of the first, own of the second.
    for both, one, other in [
        (4, 1, 0), (6, 1, 0), (12, 3, 0), (20, 5, 0), (56, 14, 0), (64, 8, 8), (400, 50, 50),
        (3, 1, 0), (11, 3, 0), (19, 5, 0), (55, 14, 0), (63, 8, 8), (399, 50, 50), (375, 62, 62),
    ]:
        for _ in range(12):
            middle = fresh(both + 4)
            for text in ([*middle, *fresh(one)], [*fresh(other), *middle]):
                rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("tile", [2048, 4])
def test_the_limit_itself_decides(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rows = texts_at_the_limit()
    draw = np.random.default_rng(2)
    # One group, in which similarity leads from text to text.
    words = [f"v{n}" for n in draw.integers(0, 1 << 60, 400)]
    for first in range(0, 60, 3):
        rows.append((len(rows), " ".join(words[first : first + 60])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r.doc_id for r in simhash.one_of_each(frame, "doc_id", "text").collect())
    assert kept == brute_force_kept(rows)


def test_groups_are_those_of_exact_similarity(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = sorted(r.doc_id for r in simhash.one_of_each(documents, "doc_id", "text").collect())
    first = {}  # of equal texts the smallest id
    for row in documents.collect():
        first[row.text] = min(row.doc_id, first.get(row.text, row.doc_id))
    assert kept == brute_force_kept([(i, t) for t, i in first.items()])


def test_sets_are_joined_like_all_pairs():
    draw = np.random.default_rng(4)
    base = draw.integers(0, 1 << 63, 60, dtype=np.uint64)
    sets = [np.unique(draw.choice(base, draw.integers(1, 60), replace=False)) for _ in range(150)]
    root = list(range(150))
    for i in range(150):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both / (len(sets[i]) + len(sets[j]) - both) >= 0.8:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    found = list(range(150))
    for a, b in simhash.alike(sets, 0.8):
        found[a] = b
    groups = {}
    for i, r in enumerate(root):
        groups.setdefault(r, set()).add(found[i])
    assert all(len(g) == 1 for g in groups.values()) and len(set(found)) == len(groups)
