"""Passes that should have a product, and products without a pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passledger.functions import ids, times
from passledger.operators.frame import dual_polarized
from passledger.operators.temporal import around, lookback, nearest_distance
from passledger.schemas import LOOKBACK_DAYS, TOLERANCE_SECONDS, WINDOW_DAYS

GROUP = ["mgrs_tile_id", "acq_group_id_within_mgrs_tile", "pass_id"]


def expected_pass_groups(frame: DataFrame, start: str, stop: str) -> DataFrame:
    """Passes of each tile whose first acquisition lies in [start, stop).

    Rows up to a day outside are read as well, so that passes at the edges are whole; that
    bound reaches the scan, which the one on the minimum cannot.
    """
    begin, end = F.lit(start).cast("timestamp"), F.lit(stop).cast("timestamp")
    day = F.expr("interval 1 day")
    near = dual_polarized(frame).where((F.col("acq_dt") >= begin - day) & (F.col("acq_dt") < end + day))
    for c in GROUP:
        near = near.where(F.col(c).isNotNull())
    groups = near.groupBy(*GROUP).agg(
        F.min("acq_dt").alias("post_acq_dt"),
        F.size(F.collect_set("jpl_burst_id")).cast("long").alias("n_bursts"),
        F.min("track_token").alias("track_token"),
        F.sort_array(F.collect_set("jpl_burst_id")).alias("burst_ids"),
        F.sort_array(F.collect_set(ids.burst_pol())).alias("burst_pols"),
    )
    return groups.where((F.col("post_acq_dt") >= begin) & (F.col("post_acq_dt") < end))


def matched_passes(groups: DataFrame, dedup: DataFrame, tolerance: int = TOLERANCE_SECONDS) -> DataFrame:
    """`groups` with the nearest product of the tile within `tolerance` seconds, both ends included.

    The earlier acquisition, then the smaller id, wins among equally near ones.  A product
    may be matched by several passes.
    """
    width = max(1, tolerance) * 1_000_000
    passes = groups.select(*GROUP, "post_acq_dt").withColumn("_bin", F.explode(around(F.col("post_acq_dt"), width)))
    products = dedup.select("mgrs_tile_id", "opera_id", "acq_time").withColumn("_bin", times.bins(F.col("acq_time"), width))
    pairs = passes.join(products, ["mgrs_tile_id", "_bin"]).withColumn("_diff", times.seconds_between(F.col("acq_time"), F.col("post_acq_dt"))).where(F.col("_diff") <= tolerance)
    best = pairs.groupBy(*GROUP).agg(F.min(F.struct("_diff", "acq_time", "opera_id")).alias("_best"))
    out = groups.join(best, GROUP, "left")
    return out.withColumn("product_found", F.col("_best").isNotNull()).withColumn("matched_opera_id", F.coalesce("_best.opera_id", F.lit(""))).withColumn("time_diff_seconds", F.col("_best._diff")).drop("_best")


def baseline_counts(passes: DataFrame, frame: DataFrame, windows: tuple[int, ...] = LOOKBACK_DAYS, width_days: int = WINDOW_DAYS) -> DataFrame:
    """`n_bursts_with_baseline` of passes: burst|polarization keys with an acquisition in a lookback window."""
    return passes.select(*GROUP).join(_with_baseline(passes, frame, windows, width_days), GROUP, "left").fillna(0, ["n_bursts_with_baseline"])


def _with_baseline(passes: DataFrame, frame: DataFrame, windows: tuple[int, ...], width_days: int) -> DataFrame:
    """The count of passes where it is not zero."""
    keyed = passes.select(*GROUP, times.micros(F.col("post_acq_dt")).alias("_t"), F.explode("burst_pols").alias("burst_pol"))
    seen = dual_polarized(frame).select(ids.burst_pol().alias("burst_pol"), times.micros(F.col("acq_dt")).alias("_t")).dropna().distinct().withColumn("_seen", F.lit(1))
    both = keyed.unionByName(seen, allowMissingColumns=True)
    any_seen = F.coalesce(*[F.max("_seen").over(w) for w in lookback(["burst_pol"], "_t", windows, width_days)])
    based = both.withColumn("_any", any_seen).where(F.col("_seen").isNull() & F.col("_any").isNotNull() & F.col("_t").isNotNull())
    return based.groupBy(*GROUP).agg(F.count_distinct("burst_pol").alias("n_bursts_with_baseline"))


def check_coverage(groups: DataFrame, dedup: DataFrame, frame: DataFrame | None = None, tolerance: int = TOLERANCE_SECONDS, windows: tuple[int, ...] = LOOKBACK_DAYS, width_days: int = WINDOW_DAYS, product_label: str = "output") -> DataFrame:
    """Whether each pass has a product; for those without, whether there is baseline imagery."""
    df = matched_passes(groups, dedup, tolerance)
    if frame is None:
        df = df.withColumn("n_bursts_with_baseline", F.lit(None).cast("long"))
        expected, detail = F.lit(True), F.lit("baseline not checked (no lookback RTC metadata)")
    else:
        missing = df.where(~F.col("product_found"))
        df = df.join(_with_baseline(missing, frame, windows, width_days), GROUP, "left")
        df = df.withColumn("n_bursts_with_baseline", F.when(~F.col("product_found"), F.coalesce("n_bursts_with_baseline", F.lit(0))))
        expected = F.coalesce(F.col("n_bursts_with_baseline") > 0, F.lit(False))
        some = F.concat(F.col("n_bursts_with_baseline").cast("string"), F.lit("/"), F.col("n_bursts").cast("string"), F.lit(" bursts have baseline imagery"))
        detail = F.when(expected, some).otherwise(F.lit("no baseline imagery; product not expected"))
    reason = F.concat(F.lit(f"no {product_label} product for RTC pass at "), times.utc_text(F.col("post_acq_dt")), F.lit(" ("), detail, F.lit(")"))
    return df.select(
        "mgrs_tile_id", "track_token", "post_acq_dt", "pass_id", "n_bursts", "product_found", "matched_opera_id", "time_diff_seconds", "n_bursts_with_baseline",
        (~F.col("product_found") & expected).alias("missing_product_expected"), F.when(F.col("product_found"), F.lit("")).otherwise(reason).alias("reason"),
    )


def check_orphans(groups: DataFrame, dedup: DataFrame, tolerance: int = TOLERANCE_SECONDS, product_label: str = "output") -> DataFrame:
    """Products farther than `tolerance` seconds from every pass of their tile, or in a tile without."""
    df = nearest_distance(dedup.select("opera_id", "mgrs_tile_id", "acq_time"), groups, "mgrs_tile_id", "acq_time", "post_acq_dt", "nearest_pass_diff_seconds")
    far = df.where(F.col("nearest_pass_diff_seconds").isNull() | (F.col("nearest_pass_diff_seconds") > tolerance))
    return far.withColumn("reason", F.lit(f"{product_label} product exists but no matching RTC pass found in expected groups"))


def missing_passes(coverage: DataFrame) -> DataFrame:
    return coverage.where(~F.col("product_found") & F.col("missing_product_expected"))


def missing_by_tile(missing: DataFrame) -> DataFrame:
    """Missing passes of each tile and their dates in order."""
    out = missing.groupBy("mgrs_tile_id").agg(F.count("*").alias("n_missing"), F.sort_array(F.collect_list("post_acq_dt")).alias("_dates"))
    return out.select("mgrs_tile_id", "n_missing", F.array_join(F.transform("_dates", lambda t: F.date_format(t, "yyyy-MM-dd")), ";").alias("missing_post_dates"))
