"""Byte-level BPE encoding and decoding with the tiktoken library.

The rank file is read once on the driver and broadcast (its size is that of a vocabulary and
is checked). Long texts are cut in front of a blank that follows a word character: no match of
the splitting pattern holds such a pair inside, so the ids are those of the whole text. Decoding
joins the bytes of the ids; single ids need not be valid UTF-8, whole texts are.

Null text: encoded like an empty one (no ids). Repeated rows and ids give repeated rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import map_texts, quoted

#: Texts are cut into pieces of about so many characters.
PIECE_CHARS = 1 << 16
#: A rank file beyond this size is not a vocabulary to be broadcast.
MOST_RANK_BYTES = 64 << 20

SAFE_CUT = re.compile(r"(?<=\w)[ \n]")
#: The characters that the splitting pattern counts as white space, in runs too long for its
#: backtracking matcher.
LONG_BLANK = re.compile(
    "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}"
)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token bytes, from lines of base64 and rank."""
    with open(path, "rb") as file:
        data = file.read(MOST_RANK_BYTES + 1)
    if len(data) > MOST_RANK_BYTES:
        raise ValueError(f"{path} has over {MOST_RANK_BYTES} bytes")
    pairs = (line.split() for line in data.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def make_encoding(ranks: dict[bytes, int], pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )


def pieces(text: str, size: int = PIECE_CHARS) -> list[str]:
    """The text cut at safe boundaries after every ``size`` characters or more."""
    found, begin = [], 0
    while len(text) - begin > size:
        cut = SAFE_CUT.search(text, begin + size)
        if cut is None:
            break
        found.append(text[begin : cut.start()])
        begin = cut.start()
    found.append(text[begin:])
    return found


def encode_text(encoding: tiktoken.Encoding, text: str | None) -> list[int]:
    if not text:
        return []
    if len(text) <= PIECE_CHARS:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    begin = 0
    for run in LONG_BLANK.finditer(text):
        # A run is one match at the end of the text; else its last blank goes with what follows.
        end = run.end() if run.end() == len(text) else run.end() - 1
        for piece in pieces(text[begin : run.start()]):
            ids.extend(encoding.encode_ordinary(piece))
        ids.extend(encoding._encode_single_piece(text[run.start() : end]))
        begin = end
    for piece in pieces(text[begin:]):
        ids.extend(encoding.encode_ordinary(piece))
    return ids


def encode(documents: DataFrame, text: str, ranks_path: str, pattern: str) -> DataFrame:
    """All columns of ``documents`` and, after them, ``n_tokens`` and ``tokens``.

    Columns of these two names are replaced.
    """
    known = documents.drop("n_tokens", "tokens")
    shared = known.sparkSession.sparkContext.broadcast(
        make_encoding(read_ranks(ranks_path), pattern)
    )

    def start() -> Callable[[list], list]:
        encoding = shared.value

        def work(texts: list) -> list:
            ids = [encode_text(encoding, t) for t in texts]
            return [[len(i) for i in ids], ids]

        return work

    fields = [("n_tokens", "bigint", pa.int64()), ("tokens", "array<int>", pa.list_(pa.int32()))]
    copy = "__text"
    while copy in known.columns:
        copy += "_"
    return map_texts(known.withColumn(copy, F.col(quoted(text))), copy, fields, start)


def decode(documents: DataFrame, tokens: str, ranks_path: str, pattern: str) -> DataFrame:
    """All columns but ``tokens``, and the bytes of the ids as ``decoded`` (null ids: null)."""
    known = documents if tokens == "decoded" else documents.drop("decoded")
    shared = known.sparkSession.sparkContext.broadcast(
        make_encoding(read_ranks(ranks_path), pattern)
    )

    def start() -> Callable[[list], list]:
        decode_bytes = shared.value.decode_bytes
        return lambda rows: [[None if ids is None else decode_bytes(ids) for ids in rows]]

    return map_texts(known, tokens, [("decoded", "binary", pa.binary())], start)


def round_trip(
    documents: DataFrame, id_column: str, text: str, ranks_path: str, pattern: str
) -> DataFrame:
    """Per row the number of ids, the digest of the ids and that of the bytes decoded from them."""
    shared = documents.sparkSession.sparkContext.broadcast(
        make_encoding(read_ranks(ranks_path), pattern)
    )

    def start() -> Callable[[list], list]:
        encoding = shared.value
        names = [str(i) for i in range(encoding.n_vocab)]
        decode_bytes = encoding.decode_bytes

        def work(texts: list) -> list:
            counts, of_ids, of_bytes = [], [], []
            for text in texts:
                ids = encode_text(encoding, text)
                counts.append(len(ids))
                line = ",".join([names[i] for i in ids])
                of_ids.append(hashlib.sha256(line.encode()).hexdigest())
                of_bytes.append(hashlib.sha256(decode_bytes(ids)).hexdigest())
            return [counts, of_ids, of_bytes]

        return work

    rows = documents.select(
        F.col(quoted(id_column)).alias("doc_id"), F.col(quoted(text)).alias("text")
    )
    fields = [
        ("n_tokens", "bigint", pa.int64()),
        ("ids_sha256", "string", pa.string()),
        ("decoded_sha256", "string", pa.string()),
    ]
    return map_texts(rows, "text", fields, start)
