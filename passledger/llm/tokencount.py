"""Tokens by section: whole documents are encoded once and tokens attributed by character offsets.

Sections are the lines of a text, or fields that are put together with a newline between
them.  A section reaches to the start of the next, so that every token touches one at
least.  A token that crosses a boundary counts for one section by the rule asked for:

first    the section of its first character
last     the section of its last character
largest  the section with most of its characters, the earlier of equals (the default)
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passledger.llm.common import others, text_blocks

RULES = ("first", "last", "largest")


class SectionCounter:
    """Counts with a byte-level encoding given as ranks (base64 token, rank) and a split pattern."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self._encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self._sizes = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            self._sizes[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Character starts and ends of all tokens of a whole text; character of each byte.

        Tokens that share a character's bytes all span that character.
        """
        raw = np.frombuffer(text.encode(), np.uint8)
        end = np.cumsum(self._sizes[self._encoding.encode_to_numpy(text, disallowed_special=())])
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        if not len(end):
            return end, end, char
        start = np.concatenate([[0], end[:-1]])
        return char[start], char[end - 1] + 1, char

    def count(self, text: str, starts: np.ndarray, rule: str = "largest") -> tuple[np.ndarray, np.ndarray, int]:
        """Tokens of the sections that begin at `starts` (the first at 0), those among them that cross
        a boundary, and the tokens of the text."""
        a, b, _ = self.spans(text)
        first = np.searchsorted(starts, a, side="right") - 1
        last = np.searchsorted(starts, b - 1, side="right") - 1
        crossing = np.flatnonzero(first != last)
        owner = last.copy() if rule == "last" else first.copy()
        if rule == "largest":
            bounds = np.append(starts, len(text))
            for t in crossing:
                sections = np.arange(first[t], last[t] + 1)
                share = np.minimum(bounds[sections + 1], b[t]) - np.maximum(bounds[sections], a[t])
                owner[t] = sections[share.argmax()]
        return np.bincount(owner, minlength=len(starts)), np.bincount(owner[crossing], minlength=len(starts)), len(a)


def line_starts(text: str) -> np.ndarray:
    """Where the lines of a text begin; a newline belongs to the line that it ends."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    starts = np.flatnonzero(points[:-1] == 10) + 1
    return np.concatenate([[0], starts]).astype(np.int64)


_COUNTERS: dict[int, SectionCounter] = {}


def _counter(ranks: bytes, pattern: str) -> SectionCounter:
    """One counter a Python worker, kept between its tasks."""
    key = zlib.crc32(ranks + pattern.encode())
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = SectionCounter(ranks, pattern)
    return _COUNTERS[key]


def _sections(shared, schema: pa.Schema, n_fields: int, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(*shared.value)
        for batch in text_blocks(batches):
            row, section, start, end, tokens, crossing, total = ([] for _ in range(7))
            fields = [batch.column(f"field{i}").to_pylist() for i in range(n_fields)]
            for i, text in enumerate(batch.column("text").to_pylist()):
                text = text or ""
                if n_fields:
                    sizes = [len(f[i] or "") + 1 for f in fields]
                    starts = np.cumsum([0, *sizes[:-1]])
                else:
                    starts = line_starts(text)
                n, over, whole = counter.count(text, starts, rule)
                row += [i] * len(starts)
                section += range(len(starts))
                start += starts.tolist()
                end += [*starts[1:].tolist(), len(text)]
                tokens += n.tolist()
                crossing += over.tolist()
                total += [whole] * len(starts)
            columns = {"rest": batch.column("rest").take(pa.array(row, pa.int64()))}
            columns |= {"section": pa.array(section, pa.int32()), "start": pa.array(start, pa.int64()), "end": pa.array(end, pa.int64()), "n_tokens": pa.array(tokens, pa.int64()), "n_crossing": pa.array(crossing, pa.int64()), "doc_tokens": pa.array(total, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[n].cast(schema.field(n).type) for n in schema.names], schema=schema)

    return run


def count_sections(documents: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", fields: tuple[str, ...] = (), rule: str = "largest") -> DataFrame:
    """A row for each section of each row of `documents`, in place of its text.

    Sections are the lines of `text_col`, or `fields` joined by newlines and encoded as
    one text.  Adds section int (from 0), start, end (characters), n_tokens, n_crossing
    (of these, how many cross a boundary) and doc_tokens, all long; n_tokens of a row's
    sections add up to doc_tokens.  Null and empty texts have one section without tokens;
    an empty table gives an empty result.  Other columns pass through, but for texts and
    for columns with the names of results, which give way to these.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    if rule not in RULES:
        raise ValueError(f"{rule} is not one of {RULES}")
    with open(ranks_path, "rb") as f:
        shared = documents.sparkSession.sparkContext.broadcast((f.read(), pattern))
    added = StructType.fromDDL("section int, start long, end long, n_tokens long, n_crossing long, doc_tokens long")
    keep = [c for c in others(documents, *added.names) if c not in {text_col, *fields}]
    rest = (F.struct(*[documents[f"`{c}`"] for c in keep]) if keep else F.struct(F.lit(0).alias("_"))).alias("rest")
    if fields:
        columns = [F.coalesce(documents[f"`{c}`"].cast("string"), F.lit("")) for c in fields]
        df = documents.select(rest, F.concat_ws("\n", *columns).alias("text"), *[c.alias(f"field{i}") for i, c in enumerate(columns)])
    else:
        df = documents.select(rest, documents[f"`{text_col}`"].cast("string").alias("text"))
    schema = StructType([df.schema["rest"], *added.fields])
    out = df.mapInArrow(_sections(shared, to_arrow_schema(schema), len(fields), rule), schema)
    return out.select(*[F.col(f"rest.`{c}`") for c in keep], *added.names)
