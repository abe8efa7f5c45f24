"""Token counts and files: equality with the libraries, exact round trips."""

import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from passledger.llm import tokencount, tokenfile
from tests.llm.test_exact import docs

public = pytest.importorskip("public_tokenizers")
WORD = open(public.path("word_bpe_49k.json"), encoding="utf-8").read()
ODD = ["don't we'll I've 'S", "ÀÉ ÉCOLE", "a<|endoftext|>b <|startoftext|> x", "é ́x", "日本 ΑΣ ς İ ŉ ﬁ", "a\tb\r\nc d\u0085e\x1cf", "   ", "", "12ab3.4,5", 'foo_bar-baz!!! "q" (x)', "ß ẞ Straße", "e\ńa", "x" * 5000, "<", "a<b", "'", "it's.", "  z"]


@pytest.fixture(scope="module")
def encoder():
    return tokenfile.Encoder(WORD)


def library(encoder, text):
    return encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_equals_library(encoder):
    assert encoder._by_word
    for text in ODD:
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == library(encoder, text)
    assert encoder.encode(None) == b""


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_encoder_equals_library_on_any_text(text):
    encoder = tokenfile._encoder(WORD)
    assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == library(encoder, text)


def by_library(encoder, texts, end=2):
    return [np.array([*(library(encoder, t) if t else []), end], encoder.dtype).tobytes() for t in texts]


LONG = ["a" * 63 + " " + "a" * 64 + " " + "a" * 65, "é" * 32 + " " + "É" * 33, "×a÷b Ã ã Ã́ ª µ", "a\0b \0 \0", "<|ENDOFTEXT|> <|endoftext|>", "z\u0301\nz \u0301", "aaaa abababab"]


def test_columns_equal_library(encoder, monkeypatch):
    texts = [None, *ODD, "", *LONG, None, "b " * 50, "c d"]
    column = pa.array(texts, pa.string())
    assert encoder.encode_all(column, 2).to_pylist() == by_library(encoder, texts)
    assert encoder.encode_all(column.slice(3, 9), 2).to_pylist() == by_library(encoder, texts[3:12])
    assert encoder.encode_all(column.slice(2, 0), 2).to_pylist() == [] and encoder.encode_all(pa.array([None, ""], pa.string()), 2).to_pylist() == by_library(encoder, ["", ""])
    monkeypatch.setattr(tokenfile._windows, "__defaults__", (30,))
    assert encoder.encode_all(column, 2).to_pylist() == by_library(encoder, texts)
    plain = tokenfile.Encoder(open(public.path("byte_bpe_50k.json"), encoding="utf-8").read())
    assert plain._blocks is None and plain.encode_all(pa.array(["a b", None]), 7).to_pylist() == by_library(plain, ["a b", None], 7)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text("aeinst AÀÉßÿ×'.,-1<\n\t\u0301", max_size=40)), max_size=6))
def test_columns_equal_library_on_any_text(texts):
    encoder = tokenfile._encoder(WORD)
    assert encoder.encode_all(pa.array(texts, pa.string()), 2).to_pylist() == by_library(encoder, texts)


def test_new_words_take_no_call_each(monkeypatch):
    """A corpus has new words without end; a call of the library for each took most of the CPU time."""
    calls = []
    monkeypatch.setattr(tokenfile.Encoder, "_piece", lambda self, piece, f=tokenfile.Encoder._piece: calls.append(piece) or f(self, piece))
    monkeypatch.setattr(tokenfile, "_ENCODERS", {})
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("aeinorstéÜ"), 9)) for _ in range(3000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1]), "text": pa.array([" ".join(words)])})
    (got,) = tokenfile._encoded(SimpleNamespace(value=WORD), 2)([batch])
    assert got.column("ids").to_pylist() == by_library(tokenfile._encoder(WORD), [" ".join(words)])
    assert len(calls) < 30


def test_byte_level_is_not_split_at_spaces():
    spec = open(public.path("byte_bpe_50k.json"), encoding="utf-8").read()
    e = tokenfile.Encoder(spec)
    assert not e._by_word
    assert np.frombuffer(e.encode("a b\n c"), e.dtype).tolist() == e.tokenizer.encode("a b\n c", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=700), min_size=1, max_size=8), st.integers(6, 12))
def test_segment_round_trip(lists, bits):
    ids = [np.array(x, np.uint16) for x in lists]
    counts = np.bincount(np.concatenate(ids).astype(np.int64), minlength=41)
    lengths = tokenfile.code_lengths(counts, bits)
    assert lengths.max() <= bits and (2.0 ** -lengths[lengths > 0].astype(float)).sum() <= 1
    names = [None, *range(len(ids) - 1)]
    data = tokenfile.pack_segment(names, ids, tokenfile.canonical_codes(lengths), lengths)
    got_names, n, tokens = tokenfile.unpack_segment(data, *tokenfile.decode_table(lengths))
    assert got_names == names and n.tolist() == [len(x) for x in ids] and tokens.tolist() == np.concatenate(ids).tolist()


def test_lengths_are_optimal_without_a_limit():
    import heapq

    counts = np.array([0, 1, 1, 2, 3, 5, 8, 13, 21, 34, 400, 7])
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert int((tokenfile.code_lengths(counts, 20) * counts).sum()) == cost
    with pytest.raises(ValueError):
        tokenfile.code_lengths(np.ones(9), 3)


def test_round_trip(spark, encoder):
    rows = [(7, "b c"), (3, "Hello, World"), (3, "Hello, World"), (3, "other"), (-5, None), (None, "no id"), (9, ""), (10, "word " * 40_000), *[(100 + i, t) for i, t in enumerate(ODD)]]
    got = sorted(tokenfile.round_trip(docs(spark, rows).repartition(5), public.path("word_bpe_49k.json")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i or 0))
    want = sorted((str(i), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ((i, [*(library(encoder, t) if t else []), 2]) for i, t in rows))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got[:-1]]).tolist()
    assert tokenfile.round_trip(docs(spark, rows).limit(0), public.path("word_bpe_49k.json")).count() == 0


# ---- counts by section


def counter():
    return tokencount._counter(open(public.path("byte_bpe_50k.tiktoken"), "rb").read(), public.PATTERN)


def test_rules_on_crossing_tokens():
    c = counter()
    text = "a\n\n\n\nb"  # some newlines are one token over several lines
    starts = tokencount.line_starts(text)
    spans = list(zip(*c.spans(text)[:2]))
    for rule in tokencount.RULES:
        want = np.zeros(len(starts), int)
        for a, b in spans:
            touched = [i for i in range(len(starts)) if starts[i] < b and (i + 1 == len(starts) or starts[i + 1] > a)]
            share = [min(b, [*starts, len(text)][i + 1]) - max(a, starts[i]) for i in touched]
            want[touched[0] if rule == "first" else touched[-1] if rule == "last" else touched[share.index(max(share))]] += 1
        got, crossing, total = c.count(text, starts, rule)
        assert got.tolist() == want.tolist() and total == len(spans) and crossing.sum() > 0


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=80))
def test_spans_cover_the_text(text):
    a, b, _ = counter().spans(text)
    covered = {i for x, y in zip(a, b) for i in range(x, y)}
    assert covered == set(range(len(text)))
    n, _, total = counter().count(text, tokencount.line_starts(text))
    assert n.sum() == total == len(a)


def test_sections(spark):
    df = docs(spark, [(1, "a b\nc\n"), (2, None), (3, ""), (4, "\n\n"), (1, "x")]).withColumn("section", F.lit("clash"))
    got = tokencount.count_sections(df, public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    assert {"rest", "size"} < set(got.columns) and got.columns.count("section") == 1
    sums = got.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r.doc_id: r.n > 0 for r in sums} == {1: True, 2: False, 3: False, 4: True}
    assert [(r.start, r.end) for r in got.where("doc_id = 1 and end >= 4").orderBy("start").collect()] == [(0, 4), (4, 6)]
    fields = tokencount.count_sections(spark.createDataFrame([(1, "title", "body text", None)], "doc_id long, t string, b string, c string"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN, fields=("t", "b", "c"))
    assert [r.section for r in fields.orderBy("section").collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        tokencount.count_sections(df, public.path("byte_bpe_50k.tiktoken"), public.PATTERN, rule="none")
