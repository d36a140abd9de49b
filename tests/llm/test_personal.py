import hashlib
import re

import numpy as np
import pytest
from hard_tables import SMALL, empty, hard  # noqa: F401

from lagline.llm import crf, labelled, personal
from lagline.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def slow_luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def slow_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [
        ("ip", *m.span()) for m in IP.finditer(text) if all(int(p) < 256 for p in m[0].split("."))
    ]
    out += [
        ("card", *m.span())
        for m in CARD.finditer(text)
        if 13 <= len(digits(m)) <= 19 and slow_luhn(digits(m))
    ]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


TEXTS = [
    "mail a.b+c@x-y.example.com. and @x.y z@no and @b.c@d.e a@b@c.d x@y..z q@w.e@r.t",
    "ip 1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 007.000.1.255 1.2.3 99999999999.1.1.1 1..2.3.4",
    "card 4637089055456426 4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 0000000000000",
    "phone +1 (826) 555-4081 +44.20.7946.0958x +12 +1 2 3 4 5 6 7 8 9 ++49 30 123456 +1 ( (",
    "２３４@x.y ²³ 1² +１２３４５６７８９ 4111111111111111² é@é.fr",
    "4111111111111111 1.2.3.4 +12345678901 a@b.co " * 30,
]


@pytest.mark.parametrize("text", TEXTS)
def test_patterns(text):
    assert personal.base_spans(text) == slow_spans(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "+1" + " " * 300_000,
                 "a@" * 100_000, "1 " * 150_000):
        personal.base_spans(text)
        personal.chains(text)


def test_chains_hold_every_hot_token_once():
    text = "word " * 30 + "x1 " + "word " * 3 + "y2" + " word" * 40 + " 3"
    found = [text[a:b] for chain in personal.chains(text) for a, b in chain]
    assert [w for w in found if w != "word"] == ["x1", "y2", "3"]
    assert personal.chains("no such") == [] and personal.chains("") == []
    assert sum(len(c) for c in personal.chains("1 " * 1000)) == 1000


def test_query_and_hard_texts(spark, hard):  # noqa: F811
    rows = QUERIES["op8_personal_data"](spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    texts_two = [(i, t) for i, t in enumerate(TEXTS)] + [(99, None), (None, TEXTS[0])]
    frame = spark.createDataFrame(texts_two, "doc_id long, text string")
    field = personal.train_field(frame, "doc_id", "text")
    more = personal.find(frame, "doc_id", "text", field).collect()
    assert len(more) == len(texts_two)
    assert personal.find(hard, "doc_id", "text", field).count() == hard.count()
    for row in rows + more:
        known = dict(texts_two) if row in more else texts
        base = slow_spans(known[row.doc_id] or "")
        lines = [f"{k}:{a}:{b}" for k, a, b in base]
        assert row.base_sha256 == hashlib.sha256(",".join(lines).encode()).hexdigest()
        assert set(lines) <= set(filter(None, row.spans.split(",")))
        assert [row[f"n_{k}"] for k in personal.KINDS] == [
            sum(s[0] == k for s in base) for k in personal.KINDS
        ]
    kept = personal.redact(hard, "text", field)
    assert kept.columns == hard.columns and kept.count() == hard.count()


def test_an_empty_table_learns_from_the_hand_labelled_one(spark, empty):  # noqa: F811
    field = personal.train_field(empty, "doc_id", "text")
    assert personal.find(empty, "doc_id", "text", field).count() == 0
    text = 'token = "b1946ac92492d2347c6235b4d2611184aa01bc33" here'
    assert personal.added_spans([text], [[]], field) == [[("secret", 9, 49)]]


#: None of these lines is in the table that the field learns from.
PLANTED = """
please write to [[email|anna (at) wood (dot) com]] soon
his mail is [[email|peter [at] field [dot] org]] now
reach [[email|nina dot berg at north dot net]] later
or ask [[email|team @ hill.example.org]] about it
call [[phone|(415) 555-0173]] tomorrow
phone [[phone|312-555-0188]] at night
tel. [[phone|040 3344 5519]] in hamburg
ring [[phone|001-212-555-0156]] again
blocked [[ip|198[.]51[.]100[.]23]] at the border
host [[ip|2001:db8:77:5::1a2b:9:44]] answered
visa [[card|4012.8888.8888.1881]] was used
card [[card|4222_2222_2222_2220]] on file
token = [[secret|"b1946ac92492d2347c6235b4d2611184aa01bc33"]] in it
password: [[secret|q7Lm92xVbT04kzPa]] was lost
api_key = [[secret|"Zx81kQw93LmTr5Yp07Vb"]] expired
commit e83c5163316f89bfbde7d9ab23ca2e25604af290 started it
md5 0cc175b9c0f1b6a831c399e269772661 of a
version 3.11.4 and 2.7.18 of it
isbn 978-0-13-110362-7 on a desk
on 2019-04-17 at 08:30 it began
order 4785380592391130 was sent
some 5 300 000 people in 2020
a blue dot at the end of the line
pages 311-455 and 10-12
the total of 12,345.67 was paid
follow @tom_b at the fair
""".strip().splitlines()


def test_what_only_the_field_finds(spark):
    """Of 15 planted spans that no pattern finds at least 10; nothing else is added."""
    assert not set(PLANTED) & set(labelled.LINES)
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    field = personal.train_field(documents, "doc_id", "text")
    found = planted = 0
    for line in PLANTED:
        text, spans = labelled.parsed(line)
        assert personal.base_spans(text) == []
        added = personal.added_spans([text], [[]], field)[0]
        for kind, a, b in added:
            assert any(kind == k and a < end and begin < b for k, begin, end in spans), line
        found, planted = found + len(added), planted + len(spans)
    assert planted == 15 and found >= 10


def test_long_tokens_are_read_whole():
    text = "x" * 500 + "5" * 300 + "y@" * 400
    chain = personal.chains(text)[0]
    assert "".join(text[a:b] for a, b in chain) == text
    assert max(b - a for a, b in chain) == personal.PIECE
    rows = personal.token_features(text, chain)
    changed = text[:560] + "@" + text[561:]
    assert personal.token_features(changed, personal.chains(changed)[0]) != rows


def test_redaction():
    text = "to a@b.co at 1.2.3.4!"
    assert personal.redacted(text, personal.base_spans(text)) == "to <email> at <ip>!"
    assert personal.redacted("abcdef", [("ip", 1, 4), ("card", 2, 5)]) == "a<ip>f"
    text = "953013749 4550997810720808"
    assert personal.base_spans(text) == []
    assert personal.cleared(text, [("card", 0, 9)]) == "<card> <card>"


def enumerated(scores, steps):
    """All tag sequences of one chain with their weights."""
    from itertools import product

    length, tags = scores.shape
    out = {}
    for path in product(range(tags), repeat=length):
        value = sum(scores[t, k] for t, k in enumerate(path))
        out[path] = value + sum(steps[a, b] for a, b in zip(path, path[1:], strict=False))
    return out


def test_chain_inference_against_all_paths():
    draw = np.random.default_rng(7)
    scores, steps = draw.normal(size=(3, 5, 3)), draw.normal(size=(3, 3))
    lengths = np.array([5, 1, 3])
    found, expected = crf.marginals(scores, lengths, steps)
    best = crf.viterbi(scores, lengths, steps)
    pairs = np.zeros((3, 3))
    for i, n in enumerate(lengths.tolist()):
        paths = enumerated(scores[i, :n], steps)
        total = sum(np.exp(v) for v in paths.values())
        assert tuple(best[i, :n]) == max(paths, key=paths.get)
        for path, value in paths.items():
            for a, b in zip(path, path[1:], strict=False):
                pairs[a, b] += np.exp(value) / total
        for t in range(n):
            for k in range(3):
                own = sum(np.exp(v) for p, v in paths.items() if p[t] == k) / total
                assert abs(found[i, t, k] - own) < 1e-9
    assert np.allclose(pairs, expected)
