"""Exact top-k inner-product search by distributed histogram selection.

Every query scores every candidate.  Rounds of score histograms, summed over all
partitions, narrow each query's interval until it holds one integer value: the
k-th largest score.  A last pass keeps what lies above it and breaks the ties at
it by the smaller id.  Per partition a query sends at most k histogram bins or k
candidates, so nothing grows with a group of equal vectors.

Queries are worked off in blocks of bounded size; only such a block travels to the
executors, and each block reads the candidates anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passledger.llm.common import pick, stored

#: Queries in a block (a parameter of `exact_topk`): bounds what is broadcast and what the driver holds.
QUERY_BLOCK = 2048
BINS = 256
_CHUNK = 1024


def _matrix(column: pa.ListArray, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: row numbers and floor(scale * x) as a float64 matrix of integers."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    out = {}
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        out[int(d)] = (rows, flat[(starts[rows, None] + np.arange(d)).astype(np.int64)])
    return out


def _products(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Integer inner products; floating point only where it is exact."""
    d = max(1, vectors.shape[1])
    bound = np.abs(vectors).max(initial=0) * np.abs(queries).max(initial=0) * d
    if bound < 2.0**53:
        return (vectors @ queries.T).astype(np.int64)
    return vectors.astype(np.int64) @ queries.T.astype(np.int64)


class _Block:
    """A block of queries as it travels to the executors."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray]):
        self.ids = ids
        lengths = np.array([len(v) for v in vectors])
        self.by_length = {int(d): (np.flatnonzero(lengths == d), np.stack([vectors[i] for i in np.flatnonzero(lengths == d)])) for d in np.unique(lengths)}

    def scored(self, batches: Iterator[pa.RecordBatch], scale: float):
        """Query numbers, candidate ids, scores (candidates x queries), own pairs masked by the third item."""
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for d, (rows, matrix) in _matrix(batch.column(1), scale).items():
                if d not in self.by_length:
                    continue
                numbers, queries = self.by_length[d]
                for at in range(0, len(rows), _CHUNK):
                    some = ids[rows[at : at + _CHUNK]]
                    yield numbers, some, _products(matrix[at : at + _CHUNK], queries), some[:, None] != self.ids[numbers][None, :]


def _histogram(block: _Block, low: np.ndarray, width: np.ndarray, step: np.ndarray, need: np.ndarray, scale: float):
    def run(batches):
        counts = np.zeros(len(block.ids) * BINS, np.int64)
        for numbers, _, scores, valid in block.scored(batches, scale):
            bins = (scores - low[numbers]) // step[numbers]
            valid &= (bins >= 0) & (scores - low[numbers] < width[numbers])
            keys = numbers * BINS + bins
            counts += np.bincount(keys[valid], minlength=len(counts))
        grid = counts.reshape(-1, BINS)
        above = np.cumsum(grid[:, ::-1], axis=1)[:, ::-1] - grid
        query, bin_ = np.nonzero((grid > 0) & (above < need[:, None]))
        yield pa.RecordBatch.from_pydict({"q": pa.array(query, pa.int32()), "bin": pa.array(bin_, pa.int32()), "n": pa.array(grid[query, bin_], pa.int64())})

    return run


def _chosen(block: _Block, kth: np.ndarray, ties: np.ndarray, scale: float):
    def run(batches):
        found: list[tuple[np.ndarray, ...]] = []
        for numbers, ids, scores, valid in block.scored(batches, scale):
            row, col = np.nonzero(valid & (scores >= kth[numbers]))
            found.append((numbers[col], ids[row], scores[row, col]))
            if sum(len(x[0]) for x in found) > 500_000:
                found = [_pruned(found, kth, ties)]
        if found:
            q, ids, scores = _pruned(found, kth, ties)
            yield pa.RecordBatch.from_pydict({"query_id": pa.array(block.ids[q], pa.int64()), "qn": pa.array(q, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.int64())})

    return run


def _pruned(found, kth, ties):
    """Of a partition's rows, those above the k-th score and the smallest ids at it."""
    q, ids, scores = (np.concatenate([x[i] for x in found]) for i in range(3))
    order = np.lexsort((ids, scores != kth[q], q))
    q, ids, scores = q[order], ids[order], scores[order]
    tie = scores == kth[q]
    starts = np.searchsorted(q, q, side="left")
    keep = ~tie | (np.arange(len(q)) - starts < ties[q])
    return q[keep], ids[keep], scores[keep]


def exact_topk(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: float = 256.0, block: int = QUERY_BLOCK) -> DataFrame:
    """The k rows of highest integer inner product for each query row.

    Components become floor(scale * x).  Candidates of a query are all rows but those
    with its own id; ties go to the smaller id; fewer than k candidates are all returned.
    Rows with a null id, a null vector or a null or non-finite component take no part.
    Vectors are compared only with vectors of the same length.  Repeated rows of an id
    are separate candidates (and queries); an empty table gives an empty result.

    Returns query_id long, rank int, vec_id long, score long.
    """
    spark = vectors.sparkSession
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = pick(vectors, vec_id=id_col, vector=vector_col).withColumn("is_query", is_query)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"), "is_query")
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", bad))
    candidates = rows.select("vec_id", "vector")
    norm = F.sqrt(F.aggregate(F.transform("vector", lambda x: F.abs(x) * scale + 1), F.lit(0.0), lambda a, x: a + x * x))
    n_queries, longest = rows.agg(F.count_if("is_query"), F.max(norm)).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n_queries:
        return spark.createDataFrame([], schema)
    # Blocks by a hash of the id hold about half the bound each, so that none exceeds it.
    n_blocks = 1 if n_queries <= block else -(-2 * n_queries // block)
    parts = []
    for b in range(n_blocks):
        own = rows.where("is_query").where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == b).select("vec_id", "vector").orderBy("vec_id").collect()
        if own:
            parts.append(_one_block(candidates, _Block(np.array([r[0] for r in own], np.int64), [np.floor(scale * np.array(r[1], np.float64)) for r in own]), longest, k, scale))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.select("query_id", "rank", "vec_id", "score")


def _one_block(candidates: DataFrame, block: _Block, longest: float, k: int, scale: float) -> DataFrame:
    n = len(block.ids)
    reach = np.zeros(n, np.int64)
    for numbers, queries in block.by_length.values():
        reach[numbers] = np.ceil(np.sqrt((queries**2).sum(axis=1)) * longest * (1 + 1e-9)).astype(np.int64) + 1
    low, width, need = -reach, 2 * reach + 1, np.full(n, k, np.int64)
    while width.max() > 1:
        step = np.maximum(1, -(-width // BINS))
        counted = candidates.mapInArrow(_histogram(block, low, width, step, need, scale), "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("q").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        wanted = F.array(*[F.lit(int(x)) for x in sorted(set(need.tolist()))])
        # One row a query at most reaches the driver: the bin with the k-th score and what lies above it.
        summed = counted.withColumn("upto", F.sum("n").over(down)).where(F.col("upto") - F.col("n") < F.array_max(wanted))
        found = {r["q"]: r["bins"] for r in summed.groupBy("q").agg(F.collect_list(F.struct("bin", "n", "upto")).alias("bins")).collect()}
        for q in range(n):
            bins = [x for x in found.get(q, []) if x["upto"] >= need[q]]
            if not bins:  # fewer than k candidates: everything counts
                low[q], width[q], need[q] = -reach[q], 1, np.iinfo(np.int32).max
                continue
            at = max(bins, key=lambda x: x["bin"])
            low[q] += at["bin"] * step[q]
            width[q], need[q] = step[q], need[q] - (at["upto"] - at["n"])
    best = candidates.mapInArrow(_chosen(block, low, need, scale), "query_id long, qn long, vec_id long, score long")
    ranked = Window.partitionBy("qn").orderBy(F.desc("score"), "vec_id")
    return stored(best.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).drop("qn"), "topk")
