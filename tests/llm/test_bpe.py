import hashlib

import public_tokenizers
import pytest
from hard_tables import SMALL, empty, hard  # noqa: F401

from lagline.llm import bpe
from lagline.llm.queries import QUERIES, ranks

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoding():
    return bpe.make_encoding(bpe.read_ranks(ranks()), PATTERN)


def digests(encoding, text):
    ids = encoding.encode_ordinary(text or "")
    line = ",".join(map(str, ids)).encode()
    return len(ids), hashlib.sha256(line).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_hard_texts_round_trip(hard, encoding):
    found = bpe.round_trip(hard, "doc_id", "text", ranks(), PATTERN).collect()
    assert len(found) == hard.count()
    expected = sorted((str(r.doc_id), *digests(encoding, r.text)) for r in hard.collect())
    assert sorted((str(r[0]), *r[1:]) for r in found) == expected


def test_pieces_give_the_ids_of_the_whole(encoding):
    text = "It's  a test,\n\n of 3 cuts. déjà 's x y  " * 40
    whole = encoding.encode_ordinary(text)
    for size in (1, 7, 50, 333):
        parts = bpe.pieces(text, size)
        assert "".join(parts) == text and len(parts) > 1
        assert [i for p in parts for i in encoding.encode_ordinary(p)] == whole


def test_blanks_too_long_for_the_matcher(encoding, monkeypatch):
    text = "ab" + " " * 20_000 + "cd" + "\n" * 15_000 + "e" + "\t" * 12_000
    expected = encoding.encode_ordinary(text)
    monkeypatch.setattr(bpe, "PIECE_CHARS", 100)
    assert bpe.encode_text(encoding, text) == expected
    ids = bpe.encode_text(encoding, "a" + " " * 1_500_000 + "b")
    assert encoding.decode_bytes(ids) == b"a" + b" " * 1_500_000 + b"b"


def test_encode_keeps_columns_and_decode_returns_the_bytes(hard):
    made = bpe.encode(hard, "text", ranks(), PATTERN)
    assert made.columns == [*[c for c in hard.columns if c not in ("n_tokens", "tokens")],
                            "n_tokens", "tokens"]
    back = bpe.decode(made, "tokens", ranks(), PATTERN)
    for row in back.select("text", "decoded", "n_tokens").collect():
        assert bytes(row.decoded).decode() == (row.text or "")


def test_empty_table(empty):
    assert bpe.round_trip(empty, "doc_id", "text", ranks(), PATTERN).collect() == []


def test_query(spark, encoding):
    rows = QUERIES["op1_byte_bpe"](spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert {r[0]: tuple(r[1:]) for r in rows} == {
        i: digests(encoding, t) for i, t in texts.items()
    }
