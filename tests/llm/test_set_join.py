import random
import re

import numpy as np
import pytest
from hard_tables import empty, hard, hard_texts  # noqa: F401

from lagline.llm import set_join

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def shingles(text, size=5):
    words = [w for w in BLANK.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return set()
    if len(words) < size:
        return {" ".join(words)}
    return {" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def slow(rows):
    """(doc_id, n_shingles, component_id) by comparing everything."""
    sets = [shingles(t) for _, t in rows]
    roots = list(range(len(rows)))

    def root(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * len(a | sets[j]):
                roots[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def joined(frame):
    found = set_join.join(frame, "doc_id", "text")
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, found.collect()), key=str)


def edited(draw, words, count):
    words = words.copy()
    for _ in range(count):
        at = draw.randrange(len(words))
        kind = draw.randrange(3)
        if kind == 0:
            words[at] = f"edit{draw.randrange(10**6)}"
        elif kind == 1:
            words.insert(at, f"more{draw.randrange(10**6)}")
        elif len(words) > 1:
            del words[at]
    return words


def made_rows(seed, count=260):
    """Families of edits of edits, one of them large, passages in many texts, short texts, copies."""
    draw = random.Random(seed)

    def fresh(n):
        return [f"w{draw.randrange(10**6)}" for _ in range(n)]

    passages = [fresh(40) for _ in range(3)]
    families = [[fresh(draw.choice([6, 9, 30, 120, 400]))] for _ in range(25)] + [[fresh(150)]]
    rows = []
    for i in range(count):
        own = families[-1] if i % 3 == 0 else draw.choice(families)
        words = edited(draw, draw.choice(own), draw.choice([0, 1, 1, 2, 5]))
        own.append(words)
        if i % 4 == 1:
            words = fresh(draw.randrange(8, 60)) + draw.choice(passages) + fresh(draw.randrange(4))
        if i % 10 == 7:
            words = draw.choice(["a b c d e", "a b c d e f", "a b", "A  B", "z", "", "a b c d e f g"]).split(" ")
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize(
    "seed, rows_limit, shingles_limit, leaf, pivots",
    [(1, 2048, 1 << 21, 32, 16), (2, 30, 1 << 21, 4, 3), (3, 12, 3000, 3, 2), (4, 2048, 4000, 8, 4)],
)
def test_same_as_comparing_everything(
    spark, monkeypatch, seed, rows_limit, shingles_limit, leaf, pivots
):
    monkeypatch.setattr(set_join, "MOST_ROWS", rows_limit)
    monkeypatch.setattr(set_join, "MOST_SHINGLES", shingles_limit)
    monkeypatch.setattr(set_join, "LEAF", leaf)
    monkeypatch.setattr(set_join, "PIVOTS", pivots)
    rows = made_rows(seed)
    expected = slow(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert joined(frame) == expected
    assert 3 < len({c for _, _, c in expected}) < 240


def test_hard_rows(hard, empty):  # noqa: F811
    assert joined(hard) == slow(hard_texts())
    assert joined(empty) == []


def test_similarity_at_the_limit(spark):
    """4 of 5 shingles link, 79 of 100 do not."""
    words = [f"w{i}" for i in range(8)]
    long = [f"v{i}" for i in range(200)]
    rows = [
        (1, " ".join(words)), (2, " ".join([*words, "new"])),  # 4 and 5 shingles
        (3, " ".join(long[:83])), (4, " ".join(long[:83] + long[100:121])),  # 79 of 100
        (5, " ".join(long[120:190])),
    ]
    found = {d: c for d, _, c in joined(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def test_cells_keep_partners_together():
    """Whatever the pivots, two partners share a cell unless a pivot links them."""
    draw = np.random.default_rng(4)
    sets = []
    for _ in range(12):
        base = draw.choice(3000, size=60, replace=False)
        for _ in range(10):
            own = base.copy()
            own[draw.integers(0, 60, 9)] = draw.integers(3000, 9000, 9)
            sets.append(np.unique(own))
    for seed in range(20):
        chosen = np.random.default_rng(seed).choice(len(sets), 5, replace=False)
        both = np.array([[len(np.intersect1d(s, sets[p])) for p in chosen] for s in sets])
        sizes = np.array([len(s) for s in sets])
        apart = 1 - both / (sizes[:, None] + sizes[chosen][None] - both)
        near = set_join.alike(both, sizes[:, None], sizes[chosen][None], 80)
        found = [set(c.tolist()) for c in set_join.cells(apart, near, 0.2)]
        for i in range(len(sets)):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if set_join.alike(common, len(sets[i]), len(sets[j]), 80):
                    linked = (near[i] & near[j]).any()
                    assert linked or any(i in c and j in c for c in found)


def test_fewer_links_than_members(spark):
    """A dense family hands on as many links as join it, not those of each pivot and cell."""
    draw = np.random.default_rng(8)
    base, rows = np.arange(60), []
    for i in range(600):
        own = base.copy()
        edits = draw.integers(1, 5)
        own[draw.choice(60, edits, replace=False)] = 1000 * (i + 1) + np.arange(edits)
        rows.append((bytes([i // 256, i % 256]), np.unique(own).tolist()))
    sets = spark.createDataFrame(rows, "key binary, hashes array<bigint>")
    members = sets.selectExpr("1L as region", "0 as tile", "key")
    links = set_join.join_regions(members, sets, 80).collect()

    def parts(pairs):
        group = {key: frozenset([key]) for key, _ in rows}
        for a, b in pairs:
            if group[a] is not group[b]:
                both = group[a] | group[b]
                group |= dict.fromkeys(both, both)
        return set(group.values())

    known = [(key, set(h)) for key, h in rows]
    exact = parts(
        (a, b)
        for i, (a, one) in enumerate(known)
        for b, other in known[:i]
        if 100 * len(one & other) >= 80 * len(one | other)
    )
    assert parts((bytes(a), bytes(b)) for a, b in links) == exact
    assert len(links) == len(rows) - len(exact)


def family(seed, count, size=100):
    """Sets that each lack some of the same members and have as many of their own."""
    draw, rows = np.random.default_rng(seed), []
    for i in range(count):
        own = np.arange(size)
        edits = draw.integers(5, 30)
        own[draw.choice(size, edits, replace=False)] = 1000 * (i + 1) + np.arange(edits)
        rows.append(np.unique(own))
    return rows


def one_by_one(sets):
    """The groups that all alike pairs join."""
    group = [frozenset([i]) for i in range(len(sets))]
    for i, one in enumerate(sets):
        for j in range(i):
            common = len(np.intersect1d(one, sets[j], assume_unique=True))
            if group[i] is not group[j] and set_join.alike(common, len(one), len(sets[j]), 80):
                whole = group[i] | group[j]
                for k in whole:
                    group[k] = whole
    return set(group)


def grouped(links, count):
    group = {i: frozenset([i]) for i in range(count)}
    for a, b in links:
        whole = group[a] | group[b]
        group |= dict.fromkeys(whole, whole)
    return set(group.values())


def test_common_members_are_counted_exactly():
    draw = np.random.default_rng(6)
    for count, most in [(2, 9), (40, 50), (90, 4000), (90, 80)]:
        sets = [np.unique(draw.integers(0, most, draw.integers(1, 60))) for _ in range(count)]
        found = set_join.in_common(sets)
        for i, one in enumerate(sets):
            for j in range(i):
                assert found[i, j] == found[j, i] == len(np.intersect1d(one, sets[j]))


def test_blocks_of_few_columns(monkeypatch):
    sets = family(2, 60)
    whole = set_join.in_common(sets)
    monkeypatch.setattr(set_join, "BLOCK", 180)
    assert (set_join.in_common(sets) == whole).all()


def test_a_task_compares_a_family_once(monkeypatch):
    """All edits of one text are in the cell of every pivot."""
    compared, leaf = [], set_join.leaf

    def counted(at, *rest):
        compared.append(len(at) ** 2)
        return leaf(at, *rest)

    monkeypatch.setattr(set_join, "leaf", counted)
    sets = family(3, 200)
    own, marked = set_join.dense(sets)
    links = set_join.joined(np.arange(len(own)), own, marked, 80)
    exact = one_by_one(sets)
    assert grouped(links, len(sets)) == exact and 1 < len(exact) < 200
    assert sum(compared) <= 200**2


def test_a_large_family_is_dealt_out_once(spark, monkeypatch):
    """Not once for each pivot whose cell holds it."""
    monkeypatch.setattr(set_join, "MOST_ROWS", 50)
    dealt, join_regions = [], set_join.join_regions

    def counted(members, *rest):
        dealt.append(members.count())
        return join_regions(members, *rest)

    monkeypatch.setattr(set_join, "join_regions", counted)
    found = family(4, 200)
    rows = [(bytes([i]), s.tolist(), len(s)) for i, s in enumerate(found)]
    sets = spark.createDataFrame(rows, "key binary, hashes array<bigint>, n long")
    members = sets.selectExpr("7L as region", "key", "n")
    links = set_join.links_of(members, sets, 80).collect()
    exact = one_by_one(found)
    assert grouped([(a[0], b[0]) for a, b in links], len(found)) == exact and 1 < len(exact) < 200
    # 4 tasks' worth: 8 halves, and each of the 200 in a tile with each half.
    assert dealt == [200 * 8]
