"""Near-duplicate detection by a chosen-path set similarity join on word shingles.

Documents with equal shingle sets form a class first; one representative of each class
goes on.  A representative's minwise tokens (coordinates of its MinHash signature) place
it in the nodes of independent trees: the first two levels of a tree take one coordinate
each.  Nodes within `node_limit` are compared exhaustively by signature, and pairs that may
reach the similarity are confirmed on their full sets.  A node up to `BLOCK_TIMES` as large
is cut into pairs of blocks, which loses nothing.  A larger one branches on coordinates
chosen by a hash of its path, 1 / similarity of them on average; it does so in several
copies with choices of their own, because a pair may part in each step.

Only components matter.  Inside a node a breadth-first search over signatures finds which
members may hang together, and emits a forest, never all pairs.  These forests join into
groups, which hold every link there can be; each group is then searched the same way on the
full shingle sets, in one task.  Groups too large for one task are searched node by node
instead, tree after tree, leaving out nodes that have become one component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passledger.llm.common import discard, frugal, pick, stored, text_blocks, utf8_values

#: A-Z become a-z; the ASCII white space 09-0D becomes a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
#: Coordinates of a signature, in bytes 4 times as many.
COORDINATES = 64
#: Chance to miss a pair at the threshold, in all trees and levels together.
MISS = 1e-6
#: Members of a node that one task compares exhaustively; times as many for a group, and bytes of its texts.
NODE_LIMIT, GROUP_TIMES = 2048, 6
GROUP_BYTES = 24_000_000
#: Nodes up to so many times the limit are cut into pairs of blocks at once; copies of a larger one, at most.
BLOCK_TIMES, MOST_COPIES = 4, 64
#: Levels of branching below the second; nodes that are too large even then fall into pairs of blocks, however many.
MAX_LEVELS = 6
_BLOCK = 1_000_000
#: Rows that branch at once: copies times 64 draws each.
_BRANCHED = 1024


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """64-bit hashes of the distinct `k`-word shingles of texts, vectorised over a block."""

    def __init__(self, k: int):
        self.k = k
        self._up = self._down = np.ones(1, np.uint64)
        rng = np.random.default_rng(20_011)
        self._factors = rng.integers(0, 1 << 63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)
        self._terms = rng.integers(0, 1 << 63, COORDINATES, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self._up) < n:
            self._up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE, np.uint64)]))
            self._down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _UNBASE, np.uint64)]))

    def sets(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text; fewer words than `k` are one shingle, no words none."""
        texts = [(x or b"").translate(_FOLD) for x in texts]
        raw = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
        self._powers(len(raw) + 1)
        inside = raw != 32
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        start, end = edge[::2], edge[1::2]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self._up[: len(raw)])])
        word = _mixed((total[end] - total[start]) * self._down[start] + (end - start).astype(np.uint64))
        bounds = np.searchsorted(start, np.cumsum([1] + [len(x) + 1 for x in texts]))
        n = max(0, len(word) - self.k + 1)
        shingle = np.zeros(n, np.uint64)
        for j in range(self.k):
            shingle = shingle * np.uint64(0xD6E8FEB86659FD93) + word[j : j + n]
        shingle = _mixed(shingle)
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= self.k:
                out.append(np.unique(shingle[a : b - self.k + 1]))
            elif b > a:
                short = np.uint64(b - a)
                for w in word[a:b]:
                    short = _mixed(np.array([short], np.uint64) * np.uint64(0xD6E8FEB86659FD93) + w)[0]
                out.append(np.array([short], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
        return out

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """MinHash signatures, a row of 32-bit coordinates for each non-empty set."""
        flat = np.concatenate(sets)
        starts = np.cumsum([0] + [len(x) for x in sets[:-1]])
        return np.stack([np.minimum.reduceat((flat * f + t) >> np.uint64(32), starts) for f, t in zip(self._factors, self._terms)], axis=1).astype(np.uint32)


def _signed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for batch in text_blocks(batches, limit=_BLOCK):
            sets = shingler.sets(utf8_values(batch.column("text")))
            full = [i for i, x in enumerate(sets) if len(x)]
            keys, signatures = [None] * len(sets), [None] * len(sets)
            if full:
                for i, row in zip(full, shingler.signatures([sets[i] for i in full])):
                    keys[i], signatures[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), row.tobytes()
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_shingles": pa.array([len(x) for x in sets], pa.int64()), "set_key": pa.array(keys, pa.binary()), "sig": pa.array(signatures, pa.binary())})

    return run


def trees_for(similarity: float, miss: float = MISS) -> int:
    """Trees whose first two levels together miss a pair at the threshold with chance `miss` at most."""
    return min(COORDINATES // 2, max(2, math.ceil(math.log(miss) / math.log(1 - similarity**2)))) if similarity < 1 else 2


def missed(similarity: float, trees: int, copies: int) -> float:
    """Chance to miss a pair at the threshold if all its nodes branch `MAX_LEVELS` times, on one set of coordinates.

    Given `m` equal coordinates, the copies of the nodes that a pair shares lose it
    independently; over the pairs of coordinates that trees start with, `m` is dealt at random.
    """
    n, q, total = COORDINATES, 1 / (similarity * COORDINATES), 0.0
    for m in range(n + 1):
        lost = 0.0
        for _ in range(MAX_LEVELS):
            lost = (1 - q + q * lost) ** m + (1 - q) ** n * m / n * (lost - 1)
        ways = np.array([1.0])
        for _ in range(trees):
            ways = np.convolve(ways, [1.0, 2.0, max(0.0, lost) ** copies])
        ways = np.convolve(ways, [float(math.comb(n - 2 * trees, i)) for i in range(n - 2 * trees + 1)])
        total += similarity**m * (1 - similarity) ** (n - m) * ways[m]
    return total


def copies_for(similarity: float, miss: float = MISS) -> int:
    """Copies of a node that branches, so that a pair at the threshold is missed with chance `miss` at
    most, or with hardly more than by the first two levels where these alone exceed it."""
    trees = trees_for(similarity)
    bound = max(miss, 1.05 * (1 - similarity**2) ** trees)
    return next((c for c in range(1, MOST_COPIES) if missed(similarity, trees, c) <= bound), MOST_COPIES)


def least_agreement(similarity: float, miss: float = MISS) -> int:
    """Equal coordinates that a pair at the threshold falls short of with chance `miss` at most."""
    tail = 0.0
    for n in range(COORDINATES + 1):
        tail += math.comb(COORDINATES, n) * similarity**n * (1 - similarity) ** (COORDINATES - n)
        if tail > miss:
            return n
    return COORDINATES


def _planted(trees: int):
    """Each representative's nodes at the second level of every tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = _signatures(batch.column("sig"))
            keys = [_mixed(_mixed(sig[:, 2 * t].astype(np.uint64) + np.uint64((t + 1) << 40)) ^ sig[:, 2 * t + 1].astype(np.uint64)) for t in range(trees)]
            yield pa.RecordBatch.from_pydict({"tree": pa.array(np.repeat(np.arange(trees), len(sig)), pa.int32()), "node": pa.array(np.concatenate(keys).view(np.int64)), "rep": pa.concat_arrays([batch.column("rep")] * trees)})

    return run


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _branched(similarity: float, copies: int = 1):
    """Children of nodes: coordinates by a hash of the path, 1 / similarity of them on average, one at
    least; from `copies` of each node, which choose independently."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, _BRANCHED) for b in batches for at in range(0, b.num_rows, _BRANCHED)):
            sig = np.tile(_signatures(batch.column("sig")).astype(np.uint64), (copies, 1))
            node = batch.column("node").to_numpy().view(np.uint64)
            node = np.concatenate([node, *[_mixed(node ^ _mixed(np.full(1, c << 32, np.uint64))) for c in range(1, copies)]])
            draw = _mixed(node[:, None] ^ _mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64))[None, :])
            chosen = draw < np.uint64(int(2.0**64 / (similarity * COORDINATES)))
            chosen |= draw == draw.min(axis=1, keepdims=True)
            row, j = np.nonzero(chosen)
            child = _mixed(_mixed(node[row] + j.astype(np.uint64) + np.uint64(1)) ^ sig[row, j])
            own = pa.array(row % batch.num_rows)
            yield pa.RecordBatch.from_pydict({"tree": batch.column("tree").take(own), "node": pa.array(child.view(np.int64)), "rep": batch.column("rep").take(own)})

    return run


def _searched(n: int, near) -> list[tuple[int, int]]:
    """A spanning forest of 0..n-1 by breadth-first search; `near(i, others)` gives which of `others` link with i."""
    left, forest = np.arange(n), []
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            i = front.pop()
            hit = near(i, left)
            found = left[hit]
            forest += [(i, int(j)) for j in found]
            front += found.tolist()
            left = left[~hit]
        # What is in front now has no unvisited partners.
    return forest


def _alike(sig: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Forest of members that agree in `least` coordinates or more."""
    return _searched(len(sig), lambda i, others: (sig[others] == sig[i]).sum(axis=1) >= least)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1]) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def _linked(sets: list[np.ndarray], sig: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Forest of sets with 100 * intersection >= percent * union; signatures pick whom to compare."""
    least = least_agreement(percent / 100)
    size = np.array([len(x) for x in sets])
    tokens, flat = np.unique(np.concatenate(sets), return_inverse=True)
    flat = flat.astype(np.int32)
    starts = np.cumsum(size) - size
    mark = np.zeros(len(tokens), bool)

    def near(i: int, others: np.ndarray) -> np.ndarray:
        low, high = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
        fits = 100 * low >= percent * high
        fits[fits] = (sig[others[fits]] == sig[i]).sum(axis=1) >= least
        hit = np.zeros(len(others), bool)
        some = others[fits]
        if len(some):
            mark[flat[starts[i] : starts[i] + size[i]]] = True
            parts = np.array_split(some, int(size[some].sum()) // _BLOCK + 1)
            common = np.concatenate([np.add.reduceat(mark[flat[_ranges(starts[p], size[p])]].astype(np.int32), np.cumsum(size[p]) - size[p]) for p in parts if len(p)])
            mark[flat[starts[i] : starts[i] + size[i]]] = False
            hit[fits] = 100 * common.astype(np.int64) >= percent * (size[i] + size[some] - common)
        return hit

    return _searched(len(sets), near)


def _by_group(key: str, edges_of):
    """Applies `edges_of` (columns of a group -> pairs of row numbers) to groups of rows sorted by `key`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(rows: list[pa.RecordBatch]):
            table = pa.Table.from_batches(rows).combine_chunks()
            keys, rep = table.column(key).to_numpy(), table.column("rep").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            pairs = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b - a > 1:
                    pairs += [(rep[a + i], rep[a + j]) for i, j in edges_of(table.slice(a, b - a))]
            return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in pairs], pa.int64()), "b": pa.array([y for _, y in pairs], pa.int64())})

        for batch in batches:
            keys = batch.column(key).to_numpy()
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            if last or held and held[-1].column(key)[-1].as_py() != keys[-1]:
                yield flush([*held, batch.slice(0, last)] if last else held)
                held = []
            held.append(batch.slice(last))
        if held:
            yield flush(held)

    return run


def _alike_in(least: int):
    return _by_group("node", lambda t: _alike(_signatures(t.column("sig").combine_chunks()), least))


def _linked_in(key: str, k: int, percent: int):
    shingler = Shingler(k)

    def edges(t: pa.Table):
        sets: list[np.ndarray] = []
        for batch in text_blocks(t.select(["text"]).to_batches(), limit=_BLOCK):
            sets += shingler.sets(utf8_values(batch.column("text")))
        parts = [shingler.signatures(sets[at : at + 256]) for at in range(0, len(sets), 256)]
        return _linked(sets, np.concatenate(parts), percent)

    return _by_group(key, edges)


def components(links: DataFrame) -> DataFrame:
    """(id, comp) of every id in `links` (a, b): comp is the smallest id reachable.

    Minimum labels of neighbours, then labels of labels, until nothing changes; each
    round is a written table.
    """
    edges = stored(links.select("a", "b").union(links.select("b", "a")).toDF("a", "b").distinct(), "edges", few=True)
    kept = stored(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.col("a").alias("old"), F.least("a", "m").alias("comp")), "labels", few=True)
    while True:
        labels = kept.select("id", "comp")
        near = edges.join(labels, edges.b == labels.id).groupBy("a").agg(F.min("comp").alias("near"))
        new = labels.join(near, labels.id == near.a, "left").select("id", F.col("comp").alias("old"), F.least("comp", F.coalesce("near", "comp")).alias("comp"))
        new = stored(new, "labels", few=True)
        up = new.select(F.col("id").alias("up"), F.col("comp").alias("top"))
        jumped = stored(new.join(up, new.comp == up.up, "left").select("id", "old", F.least("comp", F.coalesce("top", "comp")).alias("comp")), "labels", few=True)
        discard(kept, new)
        kept = jumped
        if not kept.where("comp <> old").limit(1).count():
            discard(edges)
            out = kept.select("id", "comp")
            out.scratch_path = kept.scratch_path
            return out


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 85, node_limit: int = NODE_LIMIT, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id long, n_shingles long, component_id long, kept boolean: a row for each document.

    Documents link whose sets of `k`-word shingles have 100 * intersection >= `percent` *
    union.  Words are maximal runs without ASCII white space, with A-Z lower-cased; fewer
    than `k` words are one shingle; null or empty texts have an empty set and no links, and
    are components of their own.  An id is expected on one text; rows that repeat both are
    one document.  Rows with a null id have a null component and are kept.  An empty table
    gives an empty result.
    """
    rows = pick(documents, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(rows.mapInArrow(frugal(_signed(k)), "doc_id long, n_shingles long, set_key binary, sig binary"), "signed")
    classes = stored(signed.where(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull()).groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.first("sig").alias("sig")), "classes")
    nodes = _nodes(classes.select("rep", "sig"), percent / 100, node_limit)
    labels = _merged(rows, nodes, k, percent, node_limit, group_bytes)
    discard(nodes)
    own = signed.select("doc_id", "n_shingles", "set_key")
    same = classes.where("n > 1").select("set_key", "rep")
    out = own.join(same, "set_key", "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    if labels is not None:
        out = out.join(labels, out.rep == labels.id, "left").withColumn("rep", F.coalesce("comp", "rep"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("rep"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _nodes(classes: DataFrame, similarity: float, limit: int) -> DataFrame:
    """(tree, node, rep, sig) of all nodes with two members or more, within the limit."""
    shape = "tree int, node long, rep long"
    open_ = classes.mapInArrow(frugal(_planted(trees_for(similarity))), shape)
    done, used = None, []
    for level in range(MAX_LEVELS + 1):
        open_ = stored(open_, "nodes")
        sizes = stored(open_.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), "sizes", few=True)
        used += [open_, sizes]
        fit = open_.join(sizes.where(F.col("n") <= limit).select("node"), "node")
        done = fit if done is None else done.unionByName(fit)
        large = sizes.where(F.col("n") > limit)
        if not large.limit(1).count():
            break
        rest = open_.join(large, "node")
        wide = F.col("n") > limit * BLOCK_TIMES
        ends = level == MAX_LEVELS or not large.where(wide).limit(1).count()
        done = done.unionByName(_block_pairs(rest if ends else rest.where(~wide), limit))
        if ends:
            break
        open_ = rest.where(wide).join(classes, "rep").select("tree", "node", "rep", "sig").mapInArrow(frugal(_branched(similarity, 1 if level else copies_for(similarity))), shape).distinct()
    members = stored(done.join(classes, "rep").select("tree", "node", "rep", "sig"), "members")
    discard(*used)
    return members


def _block_pairs(rows: DataFrame, limit: int) -> DataFrame:
    """Members of nodes moderately above the limit, or that do not shrink, such as sets with equal
    signatures: the node is cut into blocks, and each pair of blocks is a node of its own, so that all its pairs are still compared."""
    blocks = F.ceil(F.col("n") * 2.6 / limit) + 1
    df = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return df.select("tree", F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node"), "rep")


def _merged(rows: DataFrame, nodes: DataFrame, k: int, percent: int, limit: int, group_bytes: int) -> DataFrame | None:
    """(id, comp) of linked representatives, or None without links."""
    grouped = nodes.select("node", "rep", "sig").repartition("node").sortWithinPartitions("node", "rep")
    maybe = stored(grouped.mapInArrow(frugal(_alike_in(least_agreement(percent / 100))), "a long, b long").distinct(), "alike", few=True)
    if not maybe.limit(1).count():
        return None
    found = components(maybe)
    groups = found.select(F.col("id").alias("rep"), F.col("comp").alias("part"))
    texts = rows.select(F.col("doc_id").alias("rep"), "text").join(groups, "rep").groupBy("rep", "part").agg(F.min("text").alias("text"))
    texts = stored(texts, "texts")
    discard(maybe, found)
    sizes = texts.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    sizes = stored(sizes.withColumn("fits", (F.col("n") <= limit * GROUP_TIMES) & (F.col("bytes") <= group_bytes)), "sizes", few=True)
    small = texts.join(sizes.where("fits").select("part"), "part").repartition("part").sortWithinPartitions("part", "rep")
    links = inside = stored(small.select("part", "rep", "text").mapInArrow(frugal(_linked_in("part", k, percent)), "a long, b long"), "links")
    if sizes.where("not fits").limit(1).count():
        rest = texts.join(sizes.where("not fits").select("part"), "part").select("rep", "text")
        links = links.unionByName(_links_by_node(rest, nodes, k, percent))
    labels = components(links) if links.limit(1).count() else None
    discard(texts, sizes, inside)
    return labels


def _links_by_node(texts: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """Links among `texts`, node by node, one tree after the other."""
    members = stored(nodes.select("tree", "node", "rep").join(texts.select("rep"), "rep"), "large")
    links = labels = None
    for (tree,) in sorted(members.select("tree").distinct().collect()):
        own = members.where(F.col("tree") == tree).select("node", "rep")
        if labels is not None:
            at = own.join(labels, own.rep == labels.id, "left").select("node", "rep", F.coalesce("comp", "rep").alias("comp"))
            mixed = at.groupBy("node").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("node")
            own = own.join(mixed, "node")
        full = own.join(texts, "rep").select("node", "rep", "text").repartition("node").sortWithinPartitions("node", "rep")
        found = stored(full.mapInArrow(frugal(_linked_in("node", k, percent)), "a long, b long").distinct(), "links")
        links = found if links is None else links.unionByName(found)
        labels = components(links)
    return links
