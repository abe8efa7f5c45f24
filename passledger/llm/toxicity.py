"""Toxicity with a two-label linear-chain conditional random field over words.

Training labels documents; words get labels from them: a word of a toxic document is
toxic if it, or a beginning of it, is found in toxic documents many times as often as in
others, near copies left out, and more often than chance explains.  The field learns from windows around such words and from windows of other
documents, with word, affix, shape and neighbour features, and so tags words never seen.
Forward-backward marginals over a whole document give its expected number of toxic
words, the surest one and their share; a logistic model turns these into the score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passledger.llm.common import frugal, others, pick, text_blocks
from passledger.llm.crf import Crf, marginals, slot, train

_WORD = re.compile(r"[^\W\d_]+")
_SLOTS = 1 << 16
_STEMS = (3, 4, 5, 6, 7, 8)
#: The sample that the model is fitted on: documents of each label, the longest text in it, and characters in all.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS, SAMPLE_TOTAL = 3000, 3000, 60_000, 24_000_000
#: Marginals from which a word counts towards a document.
LIKELY = 0.3
_WINDOW = 12
_CACHE = 300_000


def types_of(word: str) -> list[str]:
    """The word and its beginnings, as what a toxic word may be known by."""
    return [word + "$"] + [word[:n] for n in _STEMS if n < len(word)]


def _own_features(word: str) -> list[int]:
    names = [f"w={word}"] + [f"p={word[:n]}" for n in _STEMS if n <= len(word)] + [f"s={word[-n:]}" for n in (3, 4) if n <= len(word)] + [f"l={min(len(word), 12)}"]
    return [slot(x, _SLOTS) for x in names]


def _near_features(word: str, side: str) -> list[int]:
    return [slot(f"{side}={word}", _SLOTS), slot(f"{side}p={word[:4]}", _SLOTS)]


#: Features of a word: its own, and two of each neighbour.
_WIDTH = 16


class Sample:
    """Labelled documents as arrays of word numbers, with one list of their words.

    A text is turned into numbers when it is added; of the texts themselves nothing is kept.
    """

    def __init__(self, rows: Iterable[tuple[str | None, int]] = ()):
        self.words: list[str] = []
        self.documents: list[np.ndarray] = []
        self.labels: list[int] = []
        self._numbers: dict[str, int] = {}
        for text, label in rows:
            self.add(text, label)

    def __len__(self) -> int:
        return len(self.documents)

    def add(self, text: str | None, label: int) -> None:
        self.documents.append(np.fromiter(map(self._number, words_of(text)), np.int32))
        self.labels.append(int(label))

    def _number(self, word: str) -> int:
        n = self._numbers.setdefault(word, len(self.words))
        if n == len(self.words):
            self.words.append(word)
        return n

    def keep(self, documents: list[int]) -> None:
        """Only some documents stay."""
        self.documents = [self.documents[i] for i in documents]
        self.labels = [self.labels[i] for i in documents]


def distinct_documents(sample: Sample, values: int = 8, same: int = 4) -> list[int]:
    """Documents but near copies of earlier ones with the same label: those that share `same` of `values` minima of hashed word triples.

    Copies would make any word of one toxic document look like a mark of many.
    """
    factors = np.random.default_rng(1).integers(1, 1 << 31, values, np.uint64) * np.uint64(2) + np.uint64(1)
    hashes = np.array([zlib.crc32(w.encode()) for w in sample.words] or [0], np.uint64)
    seen: dict[tuple[int, int, int], list[int]] = {}
    out = []
    for n, (words, y) in enumerate(zip(sample.documents, sample.labels)):
        codes = hashes[words] if len(words) else np.zeros(1, np.uint64)
        k = min(3, len(codes))
        triples = sum(codes[j : len(codes) - k + 1 + j] * np.uint64(31**j) for j in range(k))
        minima = [(y, j, int(((triples * f) >> np.uint64(17)).min())) for j, f in enumerate(factors)]
        met = Counter(d for m in minima for d in seen.get(m, ()))
        if met and met.most_common(1)[0][1] >= same:
            continue
        for m in minima:
            seen.setdefault(m, []).append(n)
        out.append(n)
    return out


def toxic_words(sample: Sample, times: float = 25.0) -> np.ndarray:
    """By word of the sample, whether a type of it is found `times` as often in toxic documents as in others, and more often than chance explains.

    Chance: the bound on a binomial tail, over as many types as there are.
    """
    numbers: dict[str, int] = {}
    types = [[numbers.setdefault(x, len(numbers)) for x in types_of(w)] for w in sample.words]
    ends = np.cumsum([0] + [len(t) for t in types])
    flat = np.fromiter((x for t in types for x in t), np.int32, int(ends[-1]))
    del types
    n = len(numbers)
    del numbers
    seen = np.zeros((2, n))
    for words, y in zip(sample.documents, sample.labels):
        own = np.unique(words)
        seen[y, np.unique(_ranges(flat, ends[own], ends[own + 1]))] += 1
    total = np.bincount(sample.labels, minlength=2)
    rate, share = (total[0] + 1) / (total[1] + 1), (total[1] + 1) / (total.sum() + 2)
    n0, n1 = seen
    with np.errstate(divide="ignore", invalid="ignore"):
        surprise = n1 * np.log(n1 / ((n1 + n0) * share)) + np.where(n0 > 0, n0 * np.log(n0 / ((n1 + n0) * (1 - share))), 0)
    known = (n1 > 0) & (n1 * rate >= times * (n0 + 0.5)) & (surprise >= np.log(n + 1) + 2)
    marked = np.concatenate([[0], np.cumsum(known[flat])])
    return marked[ends[1:]] > marked[ends[:-1]]


def _ranges(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """values[begin[0]:end[0]], values[begin[1]:end[1]] and so on, in one array."""
    sizes = end - begin
    return values[np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]


class _Windows:
    """Features of windows of words, made for the windows asked for; -1 is no word."""

    def __init__(self, words: list[str], rows: np.ndarray, left: np.ndarray, right: np.ndarray):
        used, numbers = np.unique(np.concatenate([rows.ravel(), left, right]), return_inverse=True)
        self._rows, self._left, self._right = numbers[: rows.size].reshape(rows.shape), numbers[rows.size : rows.size + len(left)], numbers[rows.size + len(left) :]
        self._own, self._before, self._after = np.zeros((len(used), _WIDTH - 4), np.int32), np.zeros((len(used), 2), np.int32), np.zeros((len(used), 2), np.int32)
        for i, w in enumerate(used.tolist()):
            if w >= 0:
                own = _own_features(words[w])
                self._own[i, : len(own)] = own
                self._before[i], self._after[i] = _near_features(words[w], "b"), _near_features(words[w], "a")

    def __len__(self) -> int:
        return len(self._rows)

    def __getitem__(self, some: np.ndarray) -> np.ndarray:
        rows = self._rows[some]
        before = np.concatenate([self._left[some][:, None], rows[:, :-1]], axis=1)
        after = np.concatenate([rows[:, 1:], self._right[some][:, None]], axis=1)
        return np.concatenate([self._own[rows], self._before[before], self._after[after]], axis=2)


@dataclass
class ToxicityModel:
    crf: Crf
    scale: np.ndarray

    def __post_init__(self):
        self._ids: dict[str, int] = {}
        self._tables = [[], [], []]
        self._lead: list[float] = (self.crf.weights[:, 1] - self.crf.weights[:, 0]).tolist()

    def __getstate__(self):
        return {"crf": self.crf, "scale": self.scale}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def _id(self, word: str) -> int:
        """Row of a word in the tables of its own score and of those it gives its neighbours."""
        lead = self._lead
        for table, rows in zip(self._tables, (_own_features(word), _near_features(word, "b"), _near_features(word, "a"))):
            table.append(sum([lead[r] for r in rows]))
        self._ids[word] = n = len(self._ids)
        return n

    def word_marginals(self, documents: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """P(toxic) of all words, one document after another, and the documents' lengths."""
        if len(self._ids) > _CACHE:
            self._ids, self._tables = {}, [[], [], []]
        get, make = self._ids.get, self._id
        lengths = np.array([len(x) for x in documents], np.int64)
        ids = np.empty(lengths.sum(), np.int64)
        at = 0
        for words in documents:
            ids[at : at + len(words)] = [i if (i := get(w)) is not None else make(w) for w in words]
            at += len(words)
        own, before, after = (np.array(x) for x in self._tables)
        if not len(ids):
            return np.zeros(0), lengths
        score = own[ids]
        starts = np.cumsum(lengths) - lengths
        left, right = before[np.roll(ids, 1)], after[np.roll(ids, -1)]
        full = lengths > 0
        left[starts[full]] = 0
        right[(starts + lengths - 1)[full]] = 0
        return marginals(score + left + right, lengths, self.crf), lengths

    def summary(self, documents: list[list[str]]) -> np.ndarray:
        """By document: expected toxic words among likely ones, the surest one, their share; a constant.

        Words below `LIKELY` do not add up, however long a text is.
        """
        p, lengths = self.word_marginals(documents)
        out = np.zeros((len(documents), 4))
        out[:, 3] = 1
        full = lengths > 0
        if full.any():
            starts = (np.cumsum(lengths) - lengths)[full]
            sums = np.add.reduceat(np.where(p >= LIKELY, p, 0.0), starts)
            out[full, 0], out[full, 1] = np.log1p(sums), np.maximum.reduceat(p, starts)
            out[full, 2] = np.sqrt(sums / lengths[full])
        return out

    def scores(self, documents: list[list[str]]) -> np.ndarray:
        return self.score_of(self.summary(documents))

    def score_of(self, summary: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summary @ self.scale, -40, 40)))

    def spans(self, texts: list[str], least: float = 0.5) -> list[list[tuple[int, int]]]:
        """By text, offsets (start, end) of runs of words that are toxic with probability `least` or more."""
        found = [[m.span() for m in _WORD.finditer(t)] for t in texts]
        p, lengths = self.word_marginals([[t[a:b].lower() for a, b in spans] for t, spans in zip(texts, found)])
        at, out = 0, []
        for spans, n in zip(found, lengths.tolist()):
            runs: list[tuple[int, int]] = []
            marks = np.nonzero(p[at : at + n] >= least)[0].tolist()
            for i, before in zip(marks, [None, *marks]):
                runs.append((runs.pop()[0] if before == i - 1 else spans[i][0], spans[i][1]))
            out.append(runs)
            at += n
        return out


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return _WORD.findall(text.lower()) if text else []


def fit(sample: Sample, seed: int = 3) -> ToxicityModel:
    """Fits on labelled documents; without both labels every document scores the share of label 1.

    Memory: four bytes a word, and what is kept of each word that is different.
    """
    share = (sum(sample.labels) + 0.5) / (len(sample) + 1)
    sample.keep(distinct_documents(sample))
    toxic = toxic_words(sample)
    rng = np.random.default_rng(seed)
    rows, labels, left, right = [], [], [], []
    for words, y in zip(sample.documents, sample.labels):
        marks = toxic[words] & bool(y)
        centres = np.nonzero(marks)[0][:8].tolist()
        centres += rng.integers(0, len(words), 3).tolist() if len(words) else []
        for c in centres:
            start = int(np.clip(c - int(rng.integers(2, _WINDOW - 2)), 0, max(0, len(words) - _WINDOW)))
            end = min(len(words), start + _WINDOW)
            row, ys = np.full(_WINDOW, -1, np.int32), np.full(_WINDOW, -1, np.int8)
            row[: end - start], ys[: end - start] = words[start:end], marks[start:end]
            rows.append(row)
            labels.append(ys)
            left.append(int(words[start - 1]) if start else -1)
            right.append(int(words[end]) if end < len(words) else -1)
    if not rows:
        return ToxicityModel(Crf(np.zeros((_SLOTS, 2)), np.zeros((2, 2)), np.zeros(2), np.zeros(2)), np.array([0, 0, 0, np.log(share / (1 - share))]))
    windows = _Windows(sample.words, np.stack(rows), np.array(left, np.int32), np.array(right, np.int32))
    model = ToxicityModel(train(windows, np.stack(labels), _SLOTS, 2, epochs=8), np.zeros(4))
    model.scale = _logistic(np.concatenate(list(_summaries(model, sample))), np.array(sample.labels, float))
    model.__post_init__()
    return model


def _summaries(model: ToxicityModel, sample: Sample, most: int = 100_000) -> Iterator[np.ndarray]:
    """Summaries of documents in blocks of about `most` words."""
    block, size = [], 0
    for i, words in enumerate(sample.documents):
        block.append([sample.words[w] for w in words.tolist()])
        size += len(words)
        if size >= most or i + 1 == len(sample):
            yield model.summary(block)
            block, size = [], 0


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, l2: float = 1e-2) -> np.ndarray:
    """Newton's method with a small ridge; both labels weigh the same."""
    beta = np.zeros(x.shape[1])
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + l2 * beta
        hessian = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + l2 * np.eye(len(beta))
        beta = beta - np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return beta


def training_sample(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic", folds: int = 5) -> Sample:
    """Labelled documents outside fold 0 of crc32(id as text), in a fixed order.

    Bounded by `SAMPLE_TOXIC`, `SAMPLE_CLEAN` and `SAMPLE_CHARS`, and to the first `SAMPLE_TOTAL`
    characters in all.  Rows without a text, an id or a label take no part; of repeated labels
    of a document the highest counts.
    """
    marks = pick(labels, doc_id=label_id, toxic=label_col).where("doc_id is not null and toxic in (0, 1)").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != 0)
    chosen = None
    for label, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN)):
        one = marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = one if chosen is None else chosen.unionByName(one)
    # The sample is bounded, so that the side to send to every executor is as well.
    rows = pick(documents, doc_id=id_col, text=text_col).where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(chosen), "doc_id")
    order = [F.xxhash64("doc_id"), "doc_id", "text"]
    first = rows.orderBy(*order).limit(SAMPLE_TOXIC + SAMPLE_CLEAN).withColumn("upto", F.sum(F.length("text")).over(Window.orderBy(*order)))
    found = first.where(F.col("upto") <= SAMPLE_TOTAL).select("text", "toxic").toArrow()
    return Sample((t.as_py(), y.as_py()) for batch in found.to_batches() for t, y in zip(batch.column(0), batch.column(1)))


#: In the model's results: score, and (start, end) of runs of offending words.
SPANS = "array<struct<start:int,end:int>>"


def _scorer(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in text_blocks(batches):
            texts = batch.column("text").to_pylist()
            summary = model.summary([words_of(t) for t in texts])
            # Only texts with a word that offends have spans to look for.
            offends = np.nonzero(summary[:, 1] >= 0.5)[0].tolist()
            found = dict(zip(offends, model.spans([texts[i] for i in offends])))
            spans = [[{"start": a, "end": b} for a, b in found.get(i, ())] for i in range(len(texts))]
            columns = {n: batch.column(n) for n in schema.names} | {"score": pa.array(model.score_of(summary)), "spans": pa.array(spans, schema.field("spans").type)}
            yield pa.RecordBatch.from_arrays([columns[n].cast(schema.field(n).type) for n in schema.names], schema=schema)

    return run


def score_toxicity(documents: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """`documents` with `_score` double, how likely label 1 is for the whole text, and `_spans`, the
    offsets (code points, end exclusive) of runs of words that offend with a probability of a half or more.

    Texts that are null, empty or without letters have no words and no spans, and score what
    the model gives to none.  Rows are scored one by one, whatever their length; repeated rows
    and ties score alike, and an empty table gives an empty result.  An input column `_score`
    or `_spans` gives way to the result.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rest = F.struct(*[documents[f"`{c}`"] for c in others(documents, "_score", "_spans")]).alias("rest")
    df = documents.select(rest, documents[f"`{text_col}`"].cast("string").alias("text"), F.lit(0.0).alias("score"), F.array().cast(SPANS).alias("spans"))
    shared = df.sparkSession.sparkContext.broadcast(model)
    out = df.mapInArrow(frugal(_scorer(shared, to_arrow_schema(df.schema))), df.schema)
    return out.select("rest.*", F.col("score").alias("_score"), F.col("spans").alias("_spans"))
