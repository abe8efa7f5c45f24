"""Benchmark decontamination with a generalised suffix automaton over item words.

The automaton holds every item; a document's words stream through it while the
longest match ending at each word is tracked.  A word is hit when it lies inside an
occurrence of a window: `window` consecutive words of an item, or a whole shorter item.

Stretches of a document that cannot hold a window (an unknown word, or a pair of
neighbours that no item has) are passed over by a vectorised look-up first, which
never changes a result.  An automaton holds `block_chars` of item text at most;
more items make more automata, applied one after the other to the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passledger.llm.common import frugal, others, pick, text_blocks, utf8_values

#: Every ASCII byte outside 0-9, A-Z, a-z separates words; A-Z become a-z; bytes from 0x80 are word bytes.
_FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
_WORDS = re.compile(rb"[^ ]+")
#: Characters of item text in one automaton: bounds what is broadcast.
BLOCK_CHARS = 4_000_000
_SLOTS = 1 << 22


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a UTF-8 text; null has none."""
    return [] if text is None else text.translate(_FOLD).split()


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, annotated with the items of each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws]) for name, ws in items if ws]
        ends: dict[int, set] = {}
        for name, ids in coded:
            last = 0
            for x in ids:
                last = self._extend(last, x)
                if len(ids) >= window and name is not None:
                    ends.setdefault(last, set()).add(name)
        order = sorted(range(1, len(self.link)), key=lambda v: -self.length[v])
        for v in order:  # a state's items are those of every state that has it as a suffix
            up = self.link[v]
            if up > 0 and v in ends and self.length[up] >= window:
                ends.setdefault(up, set()).update(ends[v])
        whole: dict[int, list] = {}
        for name, ids in coded:
            if len(ids) < window:
                v = 0
                for x in ids:
                    v = self.next[v][x]
                whole.setdefault(v, []).append((len(ids), name))
        #: By state: items whose window ends here; shorter items, (words, item), that end here.
        self.full: list[frozenset | None] = [None] * len(self.link)
        self.short: list[tuple] = [()] * len(self.link)
        for v in reversed(order):
            up = self.link[v]
            self.short[v] = (self.short[up] if up > 0 else ()) + tuple(whole.get(v, ()))
            if self.length[v] >= window:
                self.full[v] = self.full[up] if up > 0 and self.length[up] >= window else frozenset(ends.get(v, ()))
        pairs, heads, singles = set(), set(), set()
        for _, ids in coded:
            pairs.update(zip(ids, ids[1:]))
            if len(ids) < window:
                (singles.add(ids[0]) if len(ids) == 1 else heads.add((ids[0], ids[1])))
        self.pairs, self.heads = _table(pairs), _table(heads)
        self.singles = np.zeros(len(self.vocabulary) + 1, bool)
        self.singles[list(singles)] = True
        self.any_heads, self.any_singles = bool(heads), bool(singles)
        self.longest_short = max((len(i) for _, i in coded if len(i) < window), default=0)

    def _extend(self, last: int, x: int) -> int:
        if x in self.next[last]:
            q = self.next[last][x]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, x)
        cur = self._state(self.length[last] + 1)
        p = last
        while p >= 0 and x not in self.next[p]:
            self.next[p][x] = cur
            p = self.link[p]
        if p < 0:
            self.link[cur] = 0
        else:
            q = self.next[p][x]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, x)
        return cur

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, x: int) -> int:
        copy = self._state(self.length[p] + 1)
        self.next[copy] = dict(self.next[q])
        self.link[copy] = self.link[q]
        self.link[q] = copy
        while p >= 0 and self.next[p].get(x) == q:
            self.next[p][x] = copy
            p = self.link[p]
        return copy

    def stream(self, ids: list[int], offset: int) -> tuple[list[tuple[int, int]], set]:
        """Hit spans (start, end of words) and the items that occur, in a stretch that starts at `offset`."""
        spans: list[tuple[int, int]] = []
        found: set = set()
        v = length = 0
        for i, x in enumerate(ids, offset + 1):
            while v and x not in self.next[v]:
                v = self.link[v]
                length = self.length[v]
            v = self.next[v].get(x, 0)
            length = length + 1 if v else 0
            if length >= self.window:
                found |= self.full[v]
                spans.append((i - self.window, i))
            for n, name in self.short[v]:
                if n <= length:
                    spans.append((i - n, i))
                    if name is not None:
                        found.add(name)
        return spans, found

    def scan(self, documents: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set]]:
        """`stream` over each document's stretches that can hold a window."""
        get = self.vocabulary.get
        ids = np.zeros(sum(map(len, documents)) + len(documents) + 1, np.int64)
        starts, at = [], 1
        for ws in documents:  # a 0 stands before and after each document
            starts.append(at)
            ids[at : at + len(ws)] = [get(w, 0) for w in ws]
            at += len(ws) + 1
        out: list[tuple[list, set]] = [([], set()) for _ in documents]
        firsts = np.array(starts)
        for a, b in self._stretches(ids):
            d = int(np.searchsorted(firsts, a, side="right")) - 1
            spans, found = self.stream(ids[a:b].tolist(), a - starts[d])
            out[d][0].extend(spans)
            out[d][1].update(found)
        return [(_merged(spans), found) for spans, found in out]

    def _stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        a, b = ids[:-1], ids[1:]
        known = (a > 0) & (b > 0)
        slot = _slot(a, b)
        near = np.concatenate([[False], known & self.pairs[slot], [False]])
        edge = np.flatnonzero(near[1:] != near[:-1])
        begin, end = edge[::2], edge[1::2] + 1  # words begin..end-1 have only known neighbours
        keep = end - begin >= self.window
        marks = [(int(x), int(y)) for x, y in zip(begin[keep], end[keep])]
        if self.any_heads:
            for x in np.flatnonzero(known & self.heads[slot]):
                marks.append((int(x), int(min(x + self.longest_short, len(ids)))))
        if self.any_singles:
            marks += [(int(x), int(x) + 1) for x in np.flatnonzero(self.singles[ids])]
        joined: list[tuple[int, int]] = []
        for x, y in sorted(marks):
            y = x + int(np.argmax(ids[x:y] == 0)) if (ids[x:y] == 0).any() else y
            if joined and x <= joined[-1][1]:
                joined[-1] = (joined[-1][0], max(y, joined[-1][1]))
            else:
                joined.append((x, y))
        return joined


def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a * 2_654_435_761 + b * 40_503) >> 3) & (_SLOTS - 1)


def _table(pairs: set[tuple[int, int]]) -> np.ndarray:
    """A look-up that is true for every pair and for few others."""
    out = np.zeros(_SLOTS, bool)
    if pairs:
        x = np.array(sorted(pairs), np.int64)
        out[_slot(x[:, 0], x[:, 1])] = True
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _scanner(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in text_blocks(batches):
            texts = [words(x) for x in utf8_values(batch.column("text"))]
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
            spans, items = [], []
            for (old, had), (new, found) in zip(before, automaton.scan(texts)):
                spans.append([{"start": a, "end": b} for a, b in _merged([(x["start"], x["end"]) for x in old] + new)])
                items.append(sorted(set(had) | found))
            columns = {n: batch.column(n) for n in schema.names if n not in ("n_words", "spans", "items")}
            columns |= {"n_words": pa.array([len(x) for x in texts], pa.int64()), "spans": pa.array(spans, schema.field("spans").type), "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([columns[n].cast(schema.field(n).type) for n in schema.names], schema=schema)

    return run


def _items_in_blocks(benchmark: DataFrame, limit: int) -> list[list[tuple[str | None, list[bytes]]]]:
    """Items in blocks of bounded text; one block is with the driver at a time, but for its words."""
    rows = benchmark.where(F.col("text").isNotNull())
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = -(-total * 3 // (2 * limit)) or 1
    for b in range(n):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield [(r["item_id"], words(r["text"].encode())) for r in own.collect()]


def find_contamination(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 13, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """`documents` with `_n_words` long, `_spans` (hit spans of words) and `_items` (ids that occur).

    Null and empty texts have no words and no hits.  Items with null or empty text match
    nothing; items with a null id mark words but are in no list.  Repeated items or rows
    count once each.  An empty `benchmark` leaves every document clean.  Other columns of
    `documents` pass through unchanged; those with the names of results give way to them.
    """
    keep = others(documents, "_n_words", "_spans", "_items")
    items = pick(benchmark, item_id=item_col, text=item_text_col).select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    rest = F.struct(*[documents[f"`{c}`"] for c in keep]).alias("rest")
    df = documents.select(rest, documents[f"`{text_col}`"].cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    from pyspark.sql.pandas.types import to_arrow_schema

    for block in _items_in_blocks(items, block_chars):
        schema = df.schema
        shared = df.sparkSession.sparkContext.broadcast(SuffixAutomaton(block, window))
        df = df.mapInArrow(frugal(_scanner(shared, to_arrow_schema(schema))), schema)
    return df.select("rest.*", F.col("n_words").alias("_n_words"), F.col("spans").alias("_spans"), F.col("items").alias("_items"))


def n_hit(spans: str = "_spans") -> Column:
    """Number of hit words."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])


def is_contaminated(coverage: int = 20, spans: str = "_spans", n_words: str = "_n_words") -> Column:
    """At least one hit, and hits on one word in `coverage` or more."""
    return (n_hit(spans) > 0) & (n_hit(spans) * coverage >= F.col(n_words))


def remove_spans(documents: DataFrame, text_col: str = "text", min_words: int = 13) -> DataFrame:
    """Cuts hit spans of `min_words` or more out of the text of `find_contamination`'s rows."""
    spans = "array<struct<start:int,end:int>>"

    @F.pandas_udf("string")
    def cut(text, marks):
        return text.combine(marks, lambda t, m: _without(t, m, min_words))

    return documents.withColumn(text_col, cut(F.col(text_col), F.col("_spans").cast(spans)))


def _without(text: str | None, marks, min_words: int) -> str | None:
    marks = [(x["start"], x["end"]) for x in (marks if marks is not None else []) if x["end"] - x["start"] >= min_words]
    if text is None or not marks:
        return text
    raw = text.encode()
    at = [m.span() for m in _WORDS.finditer(raw.translate(_FOLD))]
    out, last = [], 0
    for a, b in marks:
        out.append(raw[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, raw[last:]]).decode()


def items_digest(items: Column) -> Column:
    """Lower-case hex SHA-256 of the sorted, comma-joined ids."""
    return F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256)
