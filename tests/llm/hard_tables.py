"""Tables of hard cases that every corpus operator must take; test modules import the fixtures."""

import random

import pytest

SMALL = "/root/testdata/sf0.001"

WORDS = ["alpha", "Beta", "gamma,", "délta", "eps", "zeta.", "eta", "THETA", "iota", "漢字"]


def prose(seed: int, count: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(400)) for _ in range(count))


def hard_texts() -> list[tuple]:
    shared = prose(1, 70)
    near = prose(2, 300).split()
    changed = near.copy()
    changed[150] = "other"
    return [
        (0, prose(3, 40)),
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (5, f"{prose(4, 20)} {shared} {prose(5, 30)}"),
        (6, f"{prose(6, 10)}\n{shared}\t{prose(7, 90)}"),
        (7, " ".join(near)),
        (8, " ".join(changed)),
        (9, " ".join(near)),
        (9, " ".join(near)),  # a repeated row
        (10, "".join(c.upper() if c.isascii() else c for c in " ".join(near))),
        (11, shared + " " + shared),
        (12, "same " * 200),
        (13, "same " * 120),
        (None, f"{prose(8, 5)} {shared}"),
        (None, prose(9, 60)),
        (14, prose(10, 20_000)),
        (15, "x" * 200_000),
        (16, "a b\x85c\xa0d 😀 ' 's 'll 123abc"),
    ]


@pytest.fixture(scope="session")
def hard(spark):
    """Rows (doc_id, text) with other columns named like those the operators make."""
    rows = [(i, t, "x", 7, "f", 1, None, [1]) for i, t in hard_texts()]
    schema = (
        "doc_id long, text string, key string, shard int, fingerprint string, n_tokens int, "
        "`print` string, tokens array<int>"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def empty(hard):
    return hard.limit(0)
