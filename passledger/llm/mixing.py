"""Mixing sources to target weights by systematic sampling.

Each source gets a share of all words by its weight, at most `most` times its own
words; what is above that is shared out again by weight.  Within a source every
document expects target / size copies.  The running sum of expected copies, shifted by
one random offset a source, crosses integer boundaries; a document is emitted once for
each that falls into its interval.

The running sum is built in two levels, over blocks and inside a block, so that no
task holds a whole source.  Blocks group documents of similar size, which keeps the
words taken close to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passledger.llm.common import others, word_count

#: Columns that `mix` adds.
ADDED = ("_size", "_source_size", "_target", "_copies")
#: Rows in a block, about, of a source that holds every row with one size.
BLOCK_ROWS = 512


def source_targets(sizes: DataFrame, weights: int = 3, most: int = 3) -> DataFrame:
    """`sizes` (k, source, source_size) as (k, source_size, target double): one row for each source.

    Weights 1, 2, .. `weights` repeat in the order of sources by code point.  With caps
    sorted by cap / weight, the first source that its share does not fill ends the capped ones.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("weight", ((F.row_number().over(order) - 1) % weights + 1).cast("double"))
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    share = (total - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after)
    free = weighed.withColumn("share", share).withColumn("fits", F.col("source_size") * most >= F.col("share") * F.col("weight"))
    level = F.min(F.when(F.col("fits"), F.struct(F.row_number().over(by_cap).alias("n"), "share"))).over(Window.partitionBy())["share"]
    return free.withColumn("level", level).select("k", "source_size", F.least(F.col("source_size") * F.lit(float(most)), F.coalesce(F.col("level") * F.col("weight"), F.col("source_size") * F.lit(float(most)))).alias("target"))


def unit_hash(value: Column) -> Column:
    """A number in [0, 1) from the first 8 hex digits of an MD5."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(documents: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", size_col: str | None = None, seed: int = 7, weights: int = 3, most: int = 3) -> DataFrame:
    """`documents` with `_size`, `_source_size`, `_target` and `_copies` (times the mix takes the row).

    `_size` counts runs without ASCII white space in the text, or is taken from `size_col`;
    null counts 0, null sources are one source.  A source without words has target 0 and no
    copies.  Repeated rows of an id are rows of their own; equal rows are interchangeable.
    Reruns with the same seed agree.  An empty table gives an empty result.  Input columns with
    the names of results give way to them.
    """
    size = word_count(documents[f"`{text_col}`"]) if size_col is None else F.coalesce(documents[f"`{size_col}`"].cast("long"), F.lit(0).cast("long"))
    rest = F.struct(*[documents[f"`{c}`"] for c in others(documents, *ADDED)]).alias("rest")
    rows = documents.select(rest, documents[f"`{id_col}`"].cast("string").alias("id"), documents[f"`{source_col}`"].alias("source"), size.alias("size"))
    hottest = rows.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    parts = 1
    while hottest > parts * BLOCK_ROWS:
        parts *= 2
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("id"), F.lit("null"))).cast("binary"))
    part = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % parts
    # A key without nulls, so that windows and the join share one partitioning.
    rows = rows.withColumn("k", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null")))
    rows = rows.withColumn("digest", digest).withColumn("grade", F.length(F.bin("size"))).withColumn("part", part)
    key = ["k", "grade", "part"]
    blocks = rows.groupBy("source", *key).agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    running = Window.partitionBy("k").orderBy("grade", "part").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0))).select(*key, "before")
    targets = source_targets(blocks.groupBy("source", "k").agg(F.sum("words").alias("source_size")))
    inside = Window.partitionBy(*key).orderBy("size", "digest", "id")
    ranked = rows.withColumn("rank", F.row_number().over(inside))
    joined = ranked.join(before, key).join(F.broadcast(targets) if _few(targets) else targets, "k")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = unit_hash(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("source").cast("string"), F.lit("null"))))
    place = F.col("before") + F.col("rank")
    copies = F.floor(place * rate + offset) - F.floor((place - 1) * rate + offset)
    return joined.select("rest.*", F.col("size").alias("_size"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), copies.cast("long").alias("_copies"))


#: Sources, at most, whose targets are broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def _few(targets: DataFrame) -> bool:
    return targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row of `mix` as often as it is taken, without the added columns."""
    rest = F.struct(*[mixed[f"`{c}`"] for c in others(mixed, *ADDED)]).alias("rest")
    taken = mixed.where(F.col("_copies") > 0)
    return taken.select(rest, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("rest.*")
