"""The products that a frame should lead to, and their inputs.

This enumeration is the library's own definition: the package that the audited system
uses is not public here, and agreement with it is not claimed.

* A product: one for each tile, acquisition group and pass with a burst that has a baseline.
* Its post inputs: the pass' dual-polarized granules of such bursts.
* Its pre inputs: for each (burst, polarizations) and lookback window, the latest
  granules before the pass, 4, 3 and 3 at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passledger.functions import ids, times
from passledger.operators.coverage import GROUP
from passledger.operators.frame import dual_polarized
from passledger.operators.temporal import lookback
from passledger.schemas import LOOKBACK_DAYS, MAX_PRE_PER_BURST, WINDOW_DAYS

COLUMNS = ["product_id", "mgrs_tile_id", "input_category", "opera_id", "opera_id_trunc", "jpl_burst_id", "polarizations", "track_number", "acq_dt"]


def build_expected_products(frame: DataFrame, tiles: DataFrame | None = None, windows: tuple[int, ...] = LOOKBACK_DAYS, caps: tuple[int, ...] = MAX_PRE_PER_BURST, width_days: int = WINDOW_DAYS) -> DataFrame:
    """Pre and post inputs of all expected products of a frame, or of those in `tiles`.

    Rows are dealt out twice: by pass, for its first acquisition and its posts by burst and
    polarizations, and by these, where each pass looks back over the earlier posts.
    """
    rows = dual_polarized(frame)
    if tiles is not None:
        rows = rows.join(tiles.select("mgrs_tile_id").distinct(), "mgrs_tile_id", "left_semi")
    rows = rows.select(*GROUP, "opera_id", "jpl_burst_id", "polarizations", "track_number", "acq_dt")
    for c in GROUP:
        rows = rows.where(F.col(c).isNotNull())  # one by one, so that they reach the scan
    rows = rows.withColumn("_t", times.micros(F.min("acq_dt").over(Window.partitionBy(*GROUP))))
    granule = F.struct("acq_dt", "opera_id", "track_number")
    cells = rows.where(F.col("jpl_burst_id").isNotNull()).groupBy(*GROUP, "jpl_burst_id", "polarizations", "_t").agg(F.collect_list(granule).alias("_posts"))
    # A cell's own row looks back; a row for each of its posts is there to be seen.
    listed_type = cells.schema["_posts"].dataType
    looks = F.struct(F.col("_t"), F.col("_posts"), F.lit(None).cast(listed_type.elementType).alias("_seen"))
    seen = F.transform("_posts", lambda x: F.struct(times.micros(x["acq_dt"]).alias("_t"), F.lit(None).cast(listed_type).alias("_posts"), x.alias("_seen")))
    key = ["mgrs_tile_id", "jpl_burst_id", "polarizations"]
    spread = cells.repartition(*key).select(*GROUP, "jpl_burst_id", "polarizations", F.explode(F.concat(F.array(looks), seen)).alias("_x")).select("*", "_x.*").drop("_x")
    spread = spread.where(F.col("_t").isNotNull())
    latest = [F.slice(F.array_distinct(F.sort_array(F.collect_list("_seen").over(w), asc=False)), 1, cap) for w, cap in zip(lookback(key, "_t", windows, width_days), caps, strict=True)]
    found = spread.withColumn("_pres", F.array_distinct(F.concat(*latest))).where(F.col("_posts").isNotNull() & (F.size("_pres") > 0))
    listed = lambda name, rows: F.transform(rows, lambda x: F.struct(F.lit(name).alias("input_category"), x["opera_id"].alias("opera_id"), x["track_number"].alias("track_number"), x["acq_dt"].alias("acq_dt")))
    both = found.select(*GROUP, "jpl_burst_id", "polarizations", F.explode(F.concat(listed("pre", "_pres"), listed("post", "_posts"))).alias("_x")).select("*", "_x.*")
    product = F.concat_ws("/", "mgrs_tile_id", F.col("acq_group_id_within_mgrs_tile").cast("string"), F.col("pass_id").cast("string"))
    return both.withColumn("product_id", product).withColumn("opera_id_trunc", ids.truncated("opera_id")).select(*COLUMNS)


def expected_index(expected: DataFrame) -> DataFrame:
    """First post time and tracks of each expected product."""
    posts = expected.where("input_category = 'post'").where(F.col("mgrs_tile_id").isNotNull())
    return posts.groupBy("mgrs_tile_id", "product_id").agg(F.min("acq_dt").alias("post_min_dt"), F.sort_array(F.collect_set("track_number")).alias("track_numbers"))
