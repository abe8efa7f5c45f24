"""Language of a text with a byte convolutional network, trained and applied in numpy.

Windows of `WINDOW` bytes go through byte embeddings, filters of several widths, a
rectifier, the largest response of each filter and a softmax.  A document's probability
is the mean over all windows of its whole text, weighted by their letter bytes.

For inference embeddings and filters fold into tables of responses by pairs of bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passledger.llm.common import others, pick, text_blocks

WINDOW, EMBEDDING, WIDTHS, FILTERS = 256, 8, (2, 3, 4), 16
#: The sample that the network is fitted on: documents of a language, windows of a
#: document, characters of a document, languages with so many documents (more languages share them).
SAMPLE_DOCS, SAMPLE_WINDOWS, SAMPLE_CHARS, SAMPLE_LANGS = 400, 6, 60_000, 256
#: Characters of all sampled texts together, which the driver holds; texts share them evenly.
SAMPLE_TOTAL = 96_000_000
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_IS_LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
_CHUNK = 64


def windows_of(text: bytes) -> np.ndarray:
    """All windows of a text, the last filled up with spaces."""
    n = max(1, -(-len(text) // WINDOW))
    return np.frombuffer(text.ljust(n * WINDOW), np.uint8).reshape(n, WINDOW)


@dataclass
class ByteNetwork:
    langs: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    dense: np.ndarray
    offset: np.ndarray

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_tables"}

    def tables(self) -> list[list[np.ndarray]]:
        """By width: tables of responses to bytes 0 and 1, 2 and 3, ..., and to a last single byte."""
        if "_tables" not in self.__dict__:
            self._tables = []
            for width, filters, bias in zip(WIDTHS, self.filters, self.biases):
                single = [(self.embedding @ filters[k * EMBEDDING : (k + 1) * EMBEDDING]).astype(np.float32) for k in range(width)]
                single[0] = single[0] + bias.astype(np.float32)
                pairs = [(single[k][:, None] + single[k + 1][None, :]).reshape(-1, FILTERS) for k in range(0, width - 1, 2)]
                self._tables.append(pairs + ([single[-1]] if width % 2 else []))
        return self._tables

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.langs)))
        for at in range(0, len(windows), _CHUNK):
            own = windows[at : at + _CHUNK].astype(np.intp)
            pair = own[:, :-1] * 256 + own[:, 1:]
            pooled = []
            for width, tables in zip(WIDTHS, self.tables()):
                n = WINDOW - width + 1
                total = tables[0].take(pair[:, :n], axis=0)
                for k, table in enumerate(tables[1:], 1):
                    total += table.take((pair if len(table) > 256 else own)[:, 2 * k : 2 * k + n], axis=0)
                pooled.append(total.max(axis=1))
            hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
            score = hidden @ self.dense + self.offset
            score = np.exp(score - score.max(axis=1, keepdims=True))
            out[at : at + _CHUNK] = score / score.sum(axis=1, keepdims=True)
        return out

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        """Language and probability of each whole text; `und` and 0 without letters."""
        spoken = [i for i, t in enumerate(texts) if t and self.langs and _LETTER.search(t.decode("utf-8", "replace"))]
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if spoken:
            parts = [windows_of(texts[i]) for i in spoken]
            windows = np.concatenate(parts)
            weight = _IS_LETTER[windows].sum(axis=1) + 1e-9
            starts = np.cumsum([0] + [len(p) for p in parts[:-1]])
            mean = np.add.reduceat(self.probabilities(windows) * weight[:, None], starts) / np.add.reduceat(weight, starts)[:, None]
            best = mean.argmax(axis=1)
            for i, b, row in zip(spoken, best, mean):
                langs[i], scores[i] = self.langs[b], min(1.0, row[b])
        return langs, scores


def fit(rows: list[tuple[str, str]], epochs: int = 6, rate: float = 3e-3, batch: int = 64, seed: int = 11) -> ByteNetwork:
    """Fits on (text, lang) by Adam; without rows no text gets a language."""
    rng = np.random.default_rng(seed)
    langs = sorted({y for _, y in rows})
    width = sum(FILTERS for _ in WIDTHS)
    p = [rng.normal(0, 0.5, (256, EMBEDDING))] + [rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS)) for w in WIDTHS] + [np.zeros(FILTERS) for _ in WIDTHS]
    p += [rng.normal(0, width**-0.5, (width, max(1, len(langs)))), np.zeros(max(1, len(langs)))]
    windows, labels = [], []
    for text, lang in rows:
        own = windows_of(text.encode("utf-8", "replace"))
        some = own[rng.permutation(len(own))[:SAMPLE_WINDOWS]]
        some = some[_IS_LETTER[some].any(axis=1)]
        windows.append(some)
        labels += [langs.index(lang)] * len(some)
    k = len(WIDTHS)
    if labels:
        x, y = np.concatenate(windows), np.array(labels)
        share = np.bincount(y, minlength=len(langs))
        weight = (len(y) / (len(langs) * np.maximum(1, share)))[y]
        moments = [(np.zeros_like(v), np.zeros_like(v)) for v in p]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                step += 1
                for v, g, (m, s) in zip(p, _gradients(p, x[own], y[own], weight[own]), moments):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return ByteNetwork(langs, p[0], p[1 : 1 + k], p[1 + k : 1 + 2 * k], p[-2], p[-1])


def _gradients(p: list[np.ndarray], x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Of the weighted mean cross-entropy; through the pool only the largest response has a gradient."""
    k, n = len(WIDTHS), len(x)
    embedding, dense = p[0], p[-2]
    letters = embedding[x]
    flat = letters.reshape(n, WINDOW * EMBEDDING)
    pooled, places = [], []
    for i, width in enumerate(WIDTHS):
        patches = np.lib.stride_tricks.sliding_window_view(flat, width * EMBEDDING, axis=1)[:, ::EMBEDDING]
        response = patches @ p[1 + i] + p[1 + k + i]
        places.append(response.argmax(axis=1))
        pooled.append(response.max(axis=1))
    raw = np.concatenate(pooled, axis=1)
    hidden = np.maximum(raw, 0)
    score = hidden @ dense + p[-1]
    prob = np.exp(score - score.max(axis=1, keepdims=True))
    prob /= prob.sum(axis=1, keepdims=True)
    prob[np.arange(n), y] -= 1
    delta = prob * weight[:, None] / n
    back = (delta @ dense.T) * (raw > 0)
    grads = [np.zeros_like(v) for v in p]
    grads[-2], grads[-1] = hidden.T @ delta, delta.sum(axis=0)
    for i, width in enumerate(WIDTHS):
        own = back[:, i * FILTERS : (i + 1) * FILTERS]
        at = places[i][:, :, None] + np.arange(width)
        taken = x[np.arange(n)[:, None, None], at]
        grads[1 + i] = np.einsum("nf,nfk->kf", own, embedding[taken].reshape(n, FILTERS, -1))
        grads[1 + k + i] = own.sum(axis=0)
        through = own[:, :, None, None] * p[1 + i].T.reshape(FILTERS, width, EMBEDDING)[None]
        np.add.at(grads[0], taken.ravel(), through.reshape(-1, EMBEDDING))
    return grads


def training_sample(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held_out: int = 1) -> list[tuple[str, str]]:
    """(text, lang) of documents outside the held-out fold of crc32(id as text), in a fixed order.

    Bounded by `SAMPLE_DOCS` a language, fewer if there are more than `SAMPLE_LANGS`
    languages but one at least, and by `SAMPLE_CHARS`, or less where the texts together would
    exceed `SAMPLE_TOTAL`, in pieces from all over a longer text.
    Of rows that repeat id and language one counts.  Rows without id, text or language take no part.
    """
    rows = pick(documents, doc_id=id_col, text=text_col, lang=lang_col)
    rows = rows.where("doc_id is not null and lang is not null").where(F.length("text") >= 1)
    rows = rows.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != held_out)
    # Only ids are ranked; texts are fetched for the chosen ones.
    ranked = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    n_langs = max(1, rows.select("lang").distinct().count())
    share = max(1, min(SAMPLE_DOCS, SAMPLE_DOCS * SAMPLE_LANGS // n_langs))
    most = max(WINDOW, min(SAMPLE_CHARS, SAMPLE_TOTAL // (share * n_langs)))
    chosen = rows.select("doc_id", "lang").distinct().withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= share).drop("n")
    found = rows.join(F.broadcast(chosen), ["doc_id", "lang"])
    piece = most // SAMPLE_WINDOWS
    step = F.floor((F.length("text") - piece) / (SAMPLE_WINDOWS - 1))
    pieces = [F.substring("text", (step * i + 1).cast("int"), F.lit(piece)) for i in range(SAMPLE_WINDOWS)]
    found = found.withColumn("text", F.when(F.length("text") <= most, F.col("text")).otherwise(F.concat(*pieces)))
    found = found.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    return [(r["text"], r["lang"]) for r in found.orderBy("lang", "doc_id").collect()]


def _predictor(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in text_blocks(batches):
            langs, scores = network.predict(batch.column("text").cast(pa.binary()).to_pylist())
            columns = {n: batch.column(n) for n in schema.names} | {"lang": pa.array(langs, pa.string()), "score": pa.array(scores)}
            yield pa.RecordBatch.from_arrays([columns[n].cast(schema.field(n).type) for n in schema.names], schema=schema)

    return run


def predict_language(documents: DataFrame, network: ByteNetwork, text_col: str = "text") -> DataFrame:
    """`documents` with `_lang` string and `_score` double (0 to 1) for the whole text.

    Null, empty and letterless texts are `und` with score 0; so is everything if the
    network had no labelled text.  Rows are scored one by one, whatever their length; of
    languages that score alike the first by name is taken, and an empty table gives an empty
    result.  Input columns `_lang` and `_score` give way to the result.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rest = F.struct(*[documents[f"`{c}`"] for c in others(documents, "_lang", "_score")]).alias("rest")
    df = documents.select(rest, documents[f"`{text_col}`"].cast("string").alias("text"), F.lit("").alias("lang"), F.lit(0.0).alias("score"))
    shared = df.sparkSession.sparkContext.broadcast(network)
    out = df.mapInArrow(_predictor(shared, to_arrow_schema(df.schema)), df.schema)
    return out.select("rest.*", F.col("lang").alias("_lang"), F.col("score").alias("_score"))
