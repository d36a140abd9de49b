"""Personal data: fixed patterns, and a conditional random field that adds spans of like shape.

The patterns find e-mail addresses, IP numbers, payment cards and phone numbers; what they find
always stays. Around every token with a digit, ``@``, ``+`` or a spelled separator ("dot", "(at)")
a chain of tokens is tagged by a linear-chain conditional random field over word-shape features,
decoded by Viterbi in batches. Runs of tagged tokens that no pattern span touches are added, as spans
of the same kinds or as ``secret`` (keys and passwords in clear).

The field is trained from two tables of labelled chains. One is made by hand (``labelled.py``):
addresses and numbers written in ways that the patterns miss, secrets, and look-alikes. The other
is a sample of the corpus: chains of at most ``SAMPLE_DOCUMENTS`` documents (of the smallest hashes of
their ids), labelled by the patterns, where a number that fails its check (Luhn, parts, digits) is
a negative example; chains with a token of which the patterns know nothing are left out. All
other work is over all rows and whole texts.

Null text: like empty (no spans). Tokens of over ``PIECE`` characters go on as further tokens,
chains of over ``CHAIN`` tokens as further chains, so that no part of a text is left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm import crf, labelled
from lagline.llm.common import map_texts, quoted, smallest_hashes

KINDS = ("email", "ip", "card", "phone")
#: What the field tags; the kinds of the patterns come first.
FIELD_KINDS = (*KINDS, "secret")
SAMPLE_DOCUMENTS = 4000
SAMPLE_CHAINS = 6000
CHAIN = 128
MARGIN = 40
BUCKETS = 1 << 13
WIDTH = 12
PIECE = 64
#: How often a chain labelled by hand counts against one of the sample.
REPEATS = 10

# Fixed patterns. Those for runs of digits begin at the first digit of a run.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
HOT = re.compile(r"[0-9@+]")
HOT_RUN = re.compile(r"[0-9@+]+")
WIDE_RUN = re.compile(r"[0-9@+]+|[(\[{<](?:at|dot)[)\]}>]|\bdot\b", re.IGNORECASE)
#: A text without any of these has no spelled separators.
SPELLED = ("dot", "Dot", "DOT", "(at", "[at", "{at", "<at", "(AT", "[AT", "{AT", "<AT")
TOKEN = re.compile(rf"\S{{1,{PIECE}}}")
HEX = re.compile(r"[0-9A-Fa-f]+")
MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z]).{14,}")
BLANK = re.compile(r"\s")
EDGES = ".,;:!?\"'()[]|"
NOT_DIGIT = re.compile(r"[^0-9]+")
DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    own = sum(map(int, digits[-1::-2]))
    return (own + sum(DOUBLED[int(d)] for d in digits[-2::-2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: the longest local part before each fitting domain."""
    found, last = [], 0
    for match in DOMAIN.finditer(text):
        begin = match.start()
        while begin > last and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < match.start():
            found.append((begin, match.end()))
            last = match.end()
    return found


def ip_fits(part: str) -> bool:
    parts = [p.lstrip("0") for p in part.split(".")]
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def card_fits(part: str) -> bool:
    digits = NOT_DIGIT.sub("", part)
    return 13 <= len(digits) <= 19 and luhn(digits)


def phone_fits(part: str) -> bool:
    return 9 <= len(NOT_DIGIT.sub("", part)) <= 15


def base_spans(text: str) -> list[Span]:
    """All pattern spans, by kind and start."""
    if not text or not HOT.search(text):
        return []
    spans: list[Span] = []
    if "@" in text:
        spans += [("email", a, b) for a, b in emails(text)]
    for kind, pattern, fits in (("ip", IP, ip_fits), ("card", CARD, card_fits)):
        spans += [(kind, *m.span()) for m in pattern.finditer(text) if fits(m[0])]
    if "+" in text:
        spans += [("phone", *m.span()) for m in PHONE.finditer(text) if phone_fits(m[0])]
    return spans


def hot_runs(text: str) -> re.Pattern:
    """What finds the places around which a text has chains."""
    return WIDE_RUN if any(s in text for s in SPELLED) else HOT_RUN


def chains(text: str) -> list[list[tuple[int, int]]]:
    """Chains of token places: hot tokens with the words near them."""
    regions: list[list[int]] = []
    for hot in hot_runs(text).finditer(text):
        begin, end = max(hot.start() - MARGIN, 0), min(hot.end() + MARGIN, len(text))
        if regions and begin <= regions[-1][1]:
            regions[-1][1] = end
        else:
            regions.append([begin, end])
    out: list[list[tuple[int, int]]] = []
    floor = 0
    for begin, end in regions:
        begin = max(begin, floor)
        while begin > floor and not text[begin - 1].isspace():
            begin -= 1
        blank = BLANK.search(text, end)
        floor = blank.start() if blank else len(text)
        tokens = [m.span() for m in TOKEN.finditer(text, begin, floor)]
        out += [tokens[i : i + CHAIN] for i in range(0, len(tokens), CHAIN)]
    return out


def shape(word: str) -> str:
    """The word's shape: A, a, 0 for letters and digits, other characters as they are, runs once."""
    out = []
    for c in word:
        kind = "0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def _bucket(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=4).digest(), "big") % BUCKETS


def token_features(text: str, places: list[tuple[int, int]]) -> list[list[int]]:
    """Feature numbers per token: shapes of it and its neighbours, digits, checks, ends."""
    words = [text[a:b] for a, b in places]
    cores = [w.strip(EDGES) for w in words]
    shapes = [shape(c) or "-" for c in cores]
    plain = [s if HOT.search(c) else c.lower() or w for s, c, w in zip(shapes, cores, words, strict=True)]
    plain = ["^", "^", *plain, "$"]
    rows = []
    for i, core in enumerate(cores):
        digits = NOT_DIGIT.sub("", core)
        bare = shapes[i]
        numeric = IP.fullmatch(core) is not None
        checks = f"{card_fits(core)} {'@' in core} {core[:1] == '+'}"
        rows.append(
            [
                _bucket("shape " + bare),
                _bucket("digits " + str(min(len(digits), 20))),
                _bucket("checks " + checks),
                _bucket(f"ip {numeric} {numeric and ip_fits(core)}"),
                _bucket("before " + (shapes[i - 1] if i else "^")),
                _bucket("after " + (shapes[i + 1] if i + 1 < len(words) else "$")),
                _bucket("start " + core[:1]) if not core[:1].isalnum() else _bucket("start a"),
                _bucket(f"long {min(len(core), 24) // 3} {bool(digits)}"),
                _bucket(
                    f"mixed {MIXED.fullmatch(core) is not None} {HEX.fullmatch(core) is not None}"
                    f" {min(len(bare), 12) // 3}"
                ),
                _bucket("word before " + plain[i + 1]),
                _bucket("two before " + plain[i]),
                _bucket("word " + plain[i + 2]),
            ]
        )
    return rows


def tagged(found: list[list[tuple[int, int]]], spans: list[Span]) -> list[list[int]]:
    """Per chain the tag of each token, from the spans that touch it."""
    rest = sorted((a, b, 1 + FIELD_KINDS.index(kind)) for kind, a, b in spans)
    out = []
    for places in found:
        rest = [s for s in rest if s[1] > places[0][0]] if rest and places else rest
        tags = [0] * len(places)
        for a, b, tag in rest:
            if a >= places[-1][1]:
                break
            for i, (begin, end) in enumerate(places):
                if begin < b and a < end:
                    tags[i] = tag
        out.append(tags)
    return out


def unknown(core: str) -> bool:
    """Whether a token that no pattern found may be personal data all the same."""
    digits = len(NOT_DIGIT.sub("", core))
    return not core.isdigit() and (
        digits >= 7 or "@" in core or MIXED.fullmatch(core) is not None
    )


def labelled_chains(documents: DataFrame, id_column: str, text: str) -> list:
    """A bounded sample of chains as (feature rows, tags)."""
    ids = F.col(quoted(id_column))
    known = documents.select(ids.alias("id")).where("id is not null")
    chosen = smallest_hashes(known, "id", SAMPLE_DOCUMENTS, known.count()).distinct()
    rows = documents.select(ids.alias("id"), F.col(quoted(text)).alias("text"))
    rows = rows.where(F.col("text").rlike("[0-9@+]")).join(F.broadcast(chosen), "id")

    def start() -> Callable[[list], list]:
        def work(texts: list) -> list:
            features, tags, keys = [], [], []
            for value in texts:
                own_f, own_t = [], []
                spans = base_spans(value)
                found = chains(value)
                for places, own in zip(found, tagged(found, spans), strict=True):
                    if any(
                        not tag and unknown(value[a:b].strip(EDGES))
                        for tag, (a, b) in zip(own, places, strict=True)
                    ):
                        continue
                    own_f.append([x for r in token_features(value, places) for x in r])
                    own_t.append(own)
                features.append(own_f)
                tags.append(own_t)
                keys.append(hashlib.blake2b(value.encode(), digest_size=8).hexdigest())
            return [features, tags, keys]

        return work

    nested = pa.list_(pa.list_(pa.int32()))
    fields = [
        ("features", "array<array<int>>", nested),
        ("tags", "array<array<int>>", nested),
        ("key", "string", pa.string()),
    ]
    made = map_texts(rows, "text", fields, start)
    pairs = made.select("key", F.posexplode(F.arrays_zip("features", "tags")).alias("at", "one"))
    pairs = pairs.select("key", "at", "one.features", "one.tags").orderBy("key", "at")
    found = pairs.limit(SAMPLE_CHAINS).collect()
    return [(np.array(r.features, np.int32).reshape(-1, WIDTH), r.tags) for r in found]


def hand_labelled() -> list:
    """The chains of the table made by hand as (feature rows, tags)."""
    out = []
    for line in labelled.LINES:
        text, spans = labelled.parsed(line)
        found = chains(text)
        out += [
            (np.array(token_features(text, places), np.int32), own)
            for places, own in zip(found, tagged(found, spans), strict=True)
        ]
    return out


def train_field(documents: DataFrame, id_column: str, text: str) -> crf.Chain:
    """The field learnt from the table made by hand and from the sample."""
    sample = hand_labelled() * REPEATS + labelled_chains(documents, id_column, text)
    features, lengths = crf.padded([f.tolist() for f, _ in sample], WIDTH)
    gold, _ = crf.padded([t for _, t in sample])
    return crf.train(features, gold, lengths, BUCKETS, 1 + len(FIELD_KINDS))


def added_spans(texts: list[str], bases: list[list[Span]], field: crf.Chain) -> list[list[Span]]:
    """Per text the spans that the field tags and no pattern span touches."""
    places, owners, fixed = [], [], []
    for number, (text, base) in enumerate(zip(texts, bases, strict=True)):
        found = chains(text)
        if found:
            places += found
            owners += [number] * len(found)
            fixed += tagged(found, base)
    out: list[list[Span]] = [[] for _ in texts]
    for first in range(0, len(places), 256):
        part = places[first : first + 256]
        owner, known = owners[first : first + 256], fixed[first : first + 256]
        rows = [token_features(texts[o], p) for o, p in zip(owner, part, strict=True)]
        features, lengths = crf.padded(rows, WIDTH)
        scores = field.scores(features)
        for i, own in enumerate(known):
            for t, tag in enumerate(own):
                if tag:
                    scores[i, t, tag] += 1e6
        tags = crf.viterbi(scores, lengths, field.steps)
        for i, (o, chain) in enumerate(zip(owner, part, strict=True)):
            open_tag, made = 0, []
            for t, (a, b) in enumerate(chain):
                tag = 0 if known[i][t] else int(tags[i, t])
                if tag and tag == open_tag:
                    made[-1][2] = b
                elif tag:
                    made.append([FIELD_KINDS[tag - 1], a, b])
                open_tag = tag
            for kind, a, b in made:
                core = texts[o][a:b]
                begin, end = a + len(core) - len(core.lstrip(EDGES)), a + len(core.rstrip(EDGES))
                if begin < end and hot_runs(core).search(core):
                    out[o].append((kind, begin, end))
    return out


def listed(spans: list[Span]) -> str:
    order = sorted(spans, key=lambda s: (FIELD_KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in order)


def find(documents: DataFrame, id_column: str, text: str, field: crf.Chain) -> DataFrame:
    """Per document: doc_id, counts per kind, digest of the pattern spans, all spans."""
    shared = documents.sparkSession.sparkContext.broadcast(field.plain())

    def start() -> Callable[[list], list]:
        own = crf.Chain(*shared.value)

        def work(texts: list) -> list:
            texts = [t or "" for t in texts]
            bases = [base_spans(t) for t in texts]
            extra = added_spans(texts, bases, own)
            counts = [[sum(s[0] == k for s in b) for b in bases] for k in KINDS]
            digests = [hashlib.sha256(listed(b).encode()).hexdigest() for b in bases]
            lines = [listed(b + e) for b, e in zip(bases, extra, strict=True)]
            return [*counts, digests, lines]

        return work

    rows = documents.select(
        F.col(quoted(id_column)).alias("doc_id"), F.col(quoted(text)).alias("text")
    )
    fields = [(f"n_{k}", "bigint", pa.int64()) for k in KINDS]
    fields += [("base_sha256", "string", pa.string()), ("spans", "string", pa.string())]
    return map_texts(rows, "text", fields, start)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlaps go as one."""
    out, begin = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= begin:
            out += [text[begin:a], f"<{kind}>"]
        begin = max(begin, b)
    return "".join(out) + text[begin:]


def cleared(text: str, spans: list[Span]) -> str:
    """The text without the spans and without what the patterns find in what is then left."""
    while spans:
        text = redacted(text, spans)
        spans = base_spans(text)
    return text


def redact(documents: DataFrame, text: str, field: crf.Chain) -> DataFrame:
    """All rows and columns, with personal data replaced in the text; a null text stays null."""
    shared = documents.sparkSession.sparkContext.broadcast(field.plain())

    def start() -> Callable[[list], list]:
        own = crf.Chain(*shared.value)

        def work(texts: list) -> list:
            known = [t or "" for t in texts]
            bases = [base_spans(t) for t in known]
            extra = added_spans(known, bases, own)
            spans = [b + e for b, e in zip(bases, extra, strict=True)]
            return [[cleared(t, s) if s else t for t, s in zip(texts, spans, strict=True)]]

        return work

    made = map_texts(documents, text, [(text, "string", pa.string())], start)
    return made.select(*[quoted(c) for c in documents.columns])
