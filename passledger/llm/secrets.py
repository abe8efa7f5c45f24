"""Secrets in text: fixed patterns, and a linear-chain conditional random field over tokens.

The field tags tokens as begin, inside or outside of a secret from their shape, their
neighbours and features of the whole text, decoded by Viterbi.  It is trained on lines
made by `training_lines`, which know their secrets.

Almost all tokens are outside whatever stands next to them.  Whether that is so follows
from a chunk of text alone and is remembered by chunk; only stretches between such tokens
go through Viterbi, with the same result as over the whole text.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passledger.llm.common import others, text_blocks
from passledger.llm.crf import Crf, slot, train

KINDS = ("assign", "access", "hex", "crf")
#: Kind, pattern, the group whose length counts, its least length.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
#: What a chunk must hold for one of the patterns to find anything near it.
_HINT = re.compile(r"passw|secret|token|api_?key|(?-i:AKIA)|(?-i:[0-9a-f]{24})", re.I | re.A)
#: A run of hex digits of the least length; a shorter run can neither match nor shift another.
_HEX = re.compile(r"[0-9a-f]{24,}")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each pattern that are long enough, by start, then kind."""
    out = []
    for kind, pattern, group, least in BASE:
        for m in (_HEX if kind == "hex" else pattern).finditer(text):
            if len(m[group]) >= least:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# ---- tokens and features

_TOKEN = re.compile(r"[A-Za-z0-9+/_-]+|[^\sA-Za-z0-9+/_-]")
_PLAIN = re.compile(r"([A-Za-z]{1,19})([.,;!?]?)")
_CLASS = {**{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "0" for c in "0123456789"}}
_SHAPE = str.maketrans(_CLASS)
_RUN = re.compile(r"(.)\1+")
_LENGTHS = (1, 2, 5, 9, 15, 19, 23, 31, 39)
#: Words that name secrets or things like them; the only ones known by name.
NAMES = ("password", "passwd", "pwd", "pass", "secret", "token", "key", "apikey", "api_key", "api-key", "auth", "authorization", "bearer", "basic", "credential", "credentials", "private", "access", "client_secret", "access_key", "secret_key", "access_token", "auth_token", "session", "cookie", "license", "id", "uuid", "sha", "md5", "commit", "phone", "card", "order", "isbn", "http", "https", "www")
_NAMES = frozenset(NAMES)
_SLOTS = 1 << 14
O, B, I = 0, 1, 2  # noqa: E741


def signature(token: str) -> tuple:
    """All that the field sees of a token."""
    low = token.lower()
    shape = token.translate(_SHAPE)
    classes = _RUN.sub(r"\1", shape)
    digits = shape.count("0") / len(token)
    return (low if low in _NAMES else "", classes[:5], sum(len(token) > n for n in _LENGTHS), 0 if not digits else 1 + sum(digits > x for x in (0.2, 0.5, 0.99)), min(4, (len(classes) + 1) // 2), token if len(token) == 1 and token.isascii() and not token.isalnum() else "")


_KNOWN: dict[tuple, tuple[list[int], list[list[int]]]] = {}


def features(sig: tuple) -> tuple[list[int], list[list[int]]]:
    """Rows for the token itself, and those it lends the tokens after it, two after it and before it."""
    if sig not in _KNOWN:
        name, shape, length, digits, changes, mark = sig
        own = [f"n={name}", f"s={shape}", f"l={length}", f"d={digits}", f"c={changes}", f"ld={length},{digits}", f"lc={length},{changes}", f"sl={shape},{length}", f"m={mark}"]
        lent = [[f"{side}n={name}", f"{side}m={mark}", f"{side}l={min(length, 5)}"] for side in ("p", "q", "f")]
        _KNOWN[sig] = [slot(x, _SLOTS) for x in own], [[slot(x, _SLOTS) for x in row] for row in lent]
    return _KNOWN[sig]


def file_features(text: str) -> list[int]:
    """Whether a text looks like code or settings, and whether it is short."""
    marks = sum(text.count(c) for c in "={};:\"'")
    share = marks / max(1, len(text))
    return [slot(f"file={sum(share > x for x in (0.005, 0.02, 0.05))}", _SLOTS), slot(f"size={len(text) > 400}", _SLOTS)]


_WIDTH = 9 + 3 * 3 + 2


def rows_of(tokens: list[str], whole: list[int]) -> list[list[int]]:
    known = [features(signature(t)) for t in tokens]
    out = []
    for i, (own, _) in enumerate(known):
        near = (known[i - 1][1][0] if i else []) + (known[i - 2][1][1] if i > 1 else []) + (known[i + 1][1][2] if i + 1 < len(tokens) else [])
        out.append(own + near + whole)
    return out


# ---- training lines

_LOWER, _MIXED, _HEXES, _BASE64 = "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"


def _word(r: random.Random) -> str:
    w = "".join(r.choice(_LOWER) for _ in range(r.choice((1, 2, 2, 3, 3, 4, 5, 6, 7, 8, 10, 13, 17))))
    return r.choice((w, w, w, w, w.title(), w.upper(), w + r.choice("éäñßö")))


def _secret(r: random.Random) -> str:
    alphabet, n = r.choice(((_HEXES, r.choice((32, 40, 64))), (_MIXED, r.randint(16, 40)), (_BASE64, r.randint(20, 60)), (_MIXED + "_-", r.randint(20, 44))))
    return r.choice(("", "", "", "sk_live_", "ghp_", "xoxb-")) + "".join(r.choice(alphabet) for _ in range(n))


def _plain(r: random.Random) -> str:
    """Things that look like secrets and are none."""
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    return r.choice((
        lambda: d(r.randint(1, 16)), lambda: f"{_word(r)}{d(2)}@mail{d(1)}.example.com", lambda: f"https://{_word(r)}.example.com/{_word(r)}/{d(5)}?page={d(1)}",
        lambda: f"{d(4)}-{d(2)}-{d(2)}", lambda: f"+{d(2)} {d(3)} {d(7)}", lambda: f"{d(3)}.{d(1)}.{d(2)}", lambda: f"{_word(r)}_{_word(r)}_{_word(r)}", lambda: f"{_word(r)}-{_word(r)}",
        lambda: f"{_word(r)}/{_word(r)}/{_word(r)}.txt", lambda: r.choice("#*%&$!?|~") * r.randint(1, 30), lambda: f"{_word(r)}={d(3)}", lambda: f"{_word(r)}: {_word(r)}", lambda: f"{r.choice(NAMES)} {_word(r)}", lambda: f"the {r.choice(NAMES)} is {_word(r)}",
        lambda: "".join(r.choice(_LOWER) for _ in range(r.randint(18, 60))), lambda: "".join(r.choice(_LOWER) for _ in range(r.randint(18, 40))).upper(), lambda: f"{d(3)}-{d(2)}-{d(4)}", lambda: f"{d(4)} {d(4)} {d(4)} {d(4)}",
    ))()


def training_lines(n: int = 3000, seed: int = 17) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Lines of text and the spans of their secrets."""
    r = random.Random(seed)
    for _ in range(n):
        line, spans = "", []
        for _ in range(r.randint(3, 12)):
            line += r.choice((_word, _word, _word, _plain))(r) + r.choice((" ", " ", " ", ", ", ". ", " | "))
        if r.random() < 0.6:
            name, value, q = r.choice(NAMES[:25]), _secret(r), r.choice(('"', "'", ""))
            head = r.choice((f"{name} = {q}", f"{name}={q}", f"{name}: {q}", f'"{name}": {q}', f"Bearer {q}", f"{name} {q}", f"{_word(r)}_{name}={q}"))
            start = len(line) + len(head)
            line += head + value + q + r.choice((" ", "; ", ". ", "\n"))
            spans.append((start, start + len(value)))
        line += " ".join(r.choice((_word, _word, _word, _plain))(r) for _ in range(r.randint(0, 8)))
        yield line, spans


def fit(n: int = 2500, width: int = 40, epochs: int = 8) -> Crf:
    rows, labels = np.zeros((n, width, _WIDTH), np.int32), np.full((n, width), -1)
    for i, (line, spans) in enumerate(training_lines(n)):
        found = list(_TOKEN.finditer(line))[-width:]
        for j, (m, own) in enumerate(zip(found, rows_of([m[0] for m in found], file_features(line)))):
            rows[i, j, : len(own)] = own
            inside = next((s for s in spans if s[0] <= m.start() < s[1]), None)
            labels[i, j] = O if inside is None else B if m.start() == inside[0] else I
    return train(rows, labels, _SLOTS, 3, epochs=epochs)


# ---- tagging


class Tagger:
    """Finds secrets in texts with a fitted field."""

    #: What a chunk is, as bits: something to look at even beside quiet chunks; lends its
    #: neighbours more than little; to look at beside such a one; may hold a base match.
    LOOK, LOUD, LOOK_LOUD, HINT = 1, 2, 4, 8

    def __init__(self, crf: Crf):
        self.crf = crf
        w = crf.weights
        self._lead = np.stack([w[:, B] - w[:, O], w[:, I] - w[:, O]], axis=1)
        self._margin = crf.certain_margin(O)
        whole = [slot(f"file={x}", _SLOTS) for x in range(4)], [slot(f"size={x}", _SLOTS) for x in (True, False)]
        self._whole = sum(self._lead[x].max(axis=0) for x in whole)
        quiet = [features(signature(t))[1] for t in ("ab", "abcd", "abcdefg", "Abcdefgh", ".", ",", "12", "abcdefghijkl")]
        self._quiet = [np.max([self._lead[q[side]].sum(axis=0) for q in quiet], axis=0).clip(0) for side in range(3)]
        self._gain = sum(self._quiet)
        loud = [features((name, "a", length, 0, 1, mark))[1] for name in ("", *NAMES) for length in range(6) for mark in ("", *map(chr, range(33, 127)))]
        self._most = sum(np.max([self._lead[q[side]].sum(axis=0) for q in loud], axis=0).clip(0) for side in range(3))
        self._by_sig: dict[tuple, int] = {}
        self._plain: dict[tuple, int] = {}
        self._chunks = _Chunks(self._chunk)

    def _token(self, sig: tuple) -> int:
        out = self._by_sig.get(sig)
        if out is None:
            own, lent = features(sig)
            lead = self._lead[own].sum(axis=0) + self._whole
            out = self.LOOK * bool((lead + self._gain).max() >= -self._margin) | self.LOOK_LOUD * bool((lead + self._most).max() >= -self._margin)
            out |= self.LOUD * any((self._lead[x].sum(axis=0) > q + 1e-12).any() for x, q in zip(lent, self._quiet))
            self._by_sig[sig] = out
        return out

    def _chunk(self, chunk: str) -> int:
        out = self.HINT * bool(_HINT.search(chunk))
        plain = _PLAIN.fullmatch(chunk)
        if plain and plain[1].lower() not in _NAMES and (plain[1].islower() or plain[1].istitle() or plain[1].isupper()):
            # Words of one case pattern and length look the same to the field.
            key = (len(plain[1]), plain[1][:1].isupper() + plain[1][-1:].isupper(), plain[2])
            if key not in self._plain:
                self._plain[key] = self._token(signature(plain[1])) | (self._token(signature(plain[2])) if plain[2] else 0)
            return out | self._plain[key]
        for t in _TOKEN.findall(chunk):
            out |= self._token(signature(t))
        return out

    def spans(self, text: str | None) -> list[Span]:
        """All spans: those of the patterns, and those of the field that overlap none of them."""
        if not text:
            return []
        if len(self._chunks) > 400_000:
            self._chunks.clear()
        flags = np.frombuffer(bytes(map(self._chunks.__getitem__, text.split())), np.uint8)
        loud = (flags & self.LOUD) > 0
        near = loud.copy()
        for shift in (1, 2):
            near[shift:] |= loud[:-shift]
        near[:-1] |= loud[1:]
        look = (flags & self.LOOK > 0) | (near & (flags & self.LOOK_LOUD > 0))
        base = base_spans(text) if (flags & self.HINT).any() else []
        if not look.any():
            return base
        found = self._decoded(text, look)
        more = [("crf", a, b) for a, b in found if not any(a < e and s < b for _, s, e in base)]
        return sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))

    def _decoded(self, text: str, look: np.ndarray) -> list[tuple[int, int]]:
        """Viterbi over the stretches to look at; the tokens around them are certainly outside."""
        chunks = [m.span() for m in re.finditer(r"\S+", text)]
        whole = file_features(text)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], look.astype(np.int8), [0]])))
        out: list[tuple[int, int]] = []
        fixed = np.array([0.0, -1e9, -1e9])
        for a, b in zip(edge[::2], edge[1::2]):
            left, right = max(0, a - 2), min(len(chunks), b + 2)
            begin, end = chunks[left][0], chunks[right - 1][1]
            tokens = list(_TOKEN.finditer(text, begin, end))
            emissions = np.stack([self.crf.weights[r].sum(axis=0) for r in rows_of([m[0] for m in tokens], whole)])
            for i, m in enumerate(tokens):
                if not chunks[a][0] <= m.start() < chunks[b - 1][1]:
                    emissions[i] = fixed
            zero = np.zeros(3)
            labels = self.crf.viterbi(emissions, self.crf.first if left == 0 else zero, self.crf.last if right == len(chunks) else zero)
            for m, y in zip(tokens, labels):
                if y == B or (y == I and (not out or out[-1][1] < m.start() and "\n" in text[out[-1][1] : m.start()])):
                    out.append(m.span())
                elif y == I:
                    out[-1] = (out[-1][0], m.end())
        return out


class _Chunks(dict):
    def __init__(self, make):
        self._make = make

    def __missing__(self, chunk: str) -> int:
        out = self._make(chunk)
        if len(chunk) < 200:
            self[chunk] = out
        return out


def joined(spans: list[Span]) -> str:
    """kind:start:end of each span, comma-joined; code points, end exclusive."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_TAGGERS: dict[int, Tagger] = {}


def _tagger(shared) -> Tagger:
    """One tagger a Python worker, kept between its tasks."""
    crf = shared.value
    if id(crf) not in _TAGGERS:
        _TAGGERS.clear()
        _TAGGERS[id(crf)] = Tagger(crf)
    return _TAGGERS[id(crf)]


def _scanned(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _tagger(shared)
        for batch in text_blocks(batches):
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in tagger.spans(t)] for t in batch.column("text").to_pylist()]
            columns = {n: batch.column(n) for n in schema.names if n != "spans"} | {"spans": pa.array(found, schema.field("spans").type)}
            yield pa.RecordBatch.from_arrays([columns[n].cast(schema.field(n).type) for n in schema.names], schema=schema)

    return run


def find_secrets(documents: DataFrame, crf: Crf, text_col: str = "text") -> DataFrame:
    """`documents` with `_spans`: array of (kind, start, end) by start, then kind.

    Kinds are assign, access and hex (fixed patterns) and crf (the field, where no pattern
    matches).  Offsets are code points, ends exclusive.  Null and empty texts have none;
    an empty table gives an empty result, and repeated rows give equal ones.  An input column
    `_spans` gives way to the result.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rest = F.struct(*[documents[f"`{c}`"] for c in others(documents, "_spans")]).alias("rest")
    spans = F.array().cast("array<struct<kind:string,start:int,end:int>>").alias("spans")
    df = documents.select(rest, documents[f"`{text_col}`"].cast("string").alias("text"), spans)
    shared = df.sparkSession.sparkContext.broadcast(crf)
    out = df.mapInArrow(_scanned(shared, to_arrow_schema(df.schema)), df.schema)
    return out.select("rest.*", F.col("spans").alias("_spans"))
