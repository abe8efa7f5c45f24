"""Audits of a product table: versions, processing order, predecessor chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passledger.functions import ids, times


def _with_extra(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns, *[c for c in ("alert_url",) if c in df.columns])


def check_duplicates(products: DataFrame) -> DataFrame:
    """All versions of acquisitions that have more than one, with what supersedes them."""
    versions = Window.partitionBy("opera_dedup_id")
    in_order = versions.orderBy(F.col("processing_time").asc_nulls_last(), "opera_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = products.where(F.col("opera_dedup_id").isNotNull()).withColumn("n_versions", F.count("*").over(versions)).where("n_versions > 1")
    df = df.withColumn("latest_opera_id", F.last("opera_id").over(in_order)).withColumn("is_latest", F.col("opera_id") == F.col("latest_opera_id"))
    df = df.withColumn("reprocessing_lag_hours", times.hours_between(F.col("processing_time"), F.min("processing_time").over(versions)))
    fate = F.when(F.col("is_latest"), F.lit("latest, kept")).otherwise(F.concat(F.lit("superseded by "), "latest_opera_id"))
    df = df.withColumn("reason", F.concat(F.col("n_versions").cast("string"), F.lit(" granules share acquisition "), "opera_dedup_id", F.lit("; "), fate))
    return _with_extra(df, ["opera_id", "mgrs_tile_id", "acq_time", "processing_time", "n_versions", "is_latest", "latest_opera_id", "reprocessing_lag_hours", "reason"])


def check_processing_order(dedup: DataFrame) -> DataFrame:
    """Products processed before the previous acquisition of their tile.

    Acquisitions with several versions are left out of the sequence, and are not evaluated.
    """
    versions = F.col("n_versions") if "n_versions" in dedup.columns else F.lit(1)
    df = dedup.withColumn("is_reprocessed", versions > 1)
    before = Window.partitionBy("mgrs_tile_id", "is_reprocessed").orderBy("acq_time", "opera_id")
    for name in ("opera_id", "acq_time", "processing_time"):
        df = df.withColumn(f"prev_{name}", F.when(~F.col("is_reprocessed") & F.col("mgrs_tile_id").isNotNull(), F.lag(name).over(before)))
    df = df.withColumn("processing_lag_hours", times.hours_between(F.col("processing_time"), F.col("prev_processing_time")))
    df = df.withColumn("evaluated", F.col("prev_opera_id").isNotNull())
    df = df.withColumn("out_of_order", F.col("evaluated") & F.coalesce(F.col("processing_lag_hours") < 0, F.lit(False)))
    late = F.concat(F.lit("processed "), times.one_decimal(-F.col("processing_lag_hours")), F.lit(" h before the previous acquisition in the tile ("), "prev_opera_id", F.lit(")"))
    df = df.withColumn("reason", F.when(F.col("out_of_order"), late).otherwise(F.lit("")))
    return _with_extra(df, ["opera_id", "mgrs_tile_id", "acq_time", "processing_time", "prev_opera_id", "prev_acq_time", "prev_processing_time", "processing_lag_hours", "is_reprocessed", "evaluated", "out_of_order", "reason"])


def check_confirmation(dedup: DataFrame, tags: DataFrame, expect_none_at_start: bool = False) -> DataFrame:
    """Whether each product's recorded predecessor is the previous product of its tile."""
    own = tags.select("opera_id", "prior_product", "error")
    df = dedup.join(own, "opera_id", "left")
    tile = Window.partitionBy("mgrs_tile_id")
    df = df.withColumn("tag_missing", F.col("error").isNull() | (F.col("error") != "") | F.col("prior_product").isNull())
    df = df.withColumn("tile_incomplete", F.bool_or("tag_missing").over(tile))
    df = df.withColumn("prior_used", ids.last_part_or_none("prior_product"))
    df = df.withColumn("prior_expected", F.lag("opera_id", 1, "None").over(tile.orderBy("acq_time", "opera_id")))
    df = df.withColumn("is_first_in_window", F.col("prior_expected") == "None")
    agrees = ids.truncated("prior_used") == ids.truncated("prior_expected")
    excused = F.lit(False) if expect_none_at_start else F.col("is_first_in_window")
    df = df.withColumn("confirmed_ok", ~F.col("tag_missing") & (agrees | excused))
    wrong = F.concat(F.lit("prior product used: "), "prior_used", F.lit("; expected: "), "prior_expected")
    reason = F.when(F.col("tag_missing"), F.lit("could not read prior product tag")).when(~F.col("confirmed_ok"), wrong).otherwise(F.lit(""))
    df = df.withColumn("reason", reason)
    return _with_extra(df, ["opera_id", "mgrs_tile_id", "acq_time", "processing_time", "prior_used", "prior_expected", "is_first_in_window", "tag_missing", "tile_incomplete", "confirmed_ok", "reason"])


def summarize_by_tile(products: DataFrame, fail_col: str) -> DataFrame:
    """Products, failures and the failed ids of each tile, ids by acquisition."""
    bad = F.coalesce(F.col(fail_col), F.lit(False))
    failed = F.sort_array(F.collect_list(F.when(bad, F.struct("acq_time", "opera_id"))))
    out = products.where(F.col("mgrs_tile_id").isNotNull()).groupBy("mgrs_tile_id").agg(F.count("*").alias("n_products"), F.count_if(bad).alias("n_failures"), failed.alias("_failed"))
    return out.select("mgrs_tile_id", "n_products", "n_failures", (F.col("n_failures") == 0).alias("ok"), F.array_join(F.transform("_failed", lambda x: x["opera_id"]), ";").alias("bad_opera_ids"))


def recent_per_tile(products: DataFrame, n: int) -> DataFrame:
    """The latest product of each tile, and of these the `n` latest."""
    newest = Window.partitionBy("mgrs_tile_id").orderBy(F.desc("acq_time"), F.desc("opera_id"))
    last = products.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth")
    return last.orderBy(F.desc("acq_time"), F.desc("opera_id")).limit(n)
