"""Tables and fixed values.  Results have these columns even when they are empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# As DDL, so that importing needs no session.
PRODUCTS = (
    "opera_id string, mgrs_tile_id string, acq_time timestamp_ntz, processing_time timestamp_ntz, sat string, "
    "alert_url string, metric_url string, alert_acq_url string, opera_dedup_id string, geometry string"
)
INPUTS = (
    "opera_id string, jpl_burst_id string, acq_dt timestamp, processing_dt timestamp, track_number int, polarizations string, "
    "url_copol string, url_crosspol string, opera_dedup_id string, geometry string"
)
TAGS = "opera_id string, error string, mgrs_tile_id string, pre_rtc_opera_ids string, post_rtc_opera_ids string, prior_product string"
RESULTS = "opera_id string, mgrs_tile_id string, inputs_correct boolean, issue_type string, issue_value string"

# Fixed values.
DUAL_POLARIZATIONS = ("VV+VH", "HH+HV")
LOOKBACK_DAYS = (365, 730, 1095)
WINDOW_DAYS = 60
MAX_PRE_PER_BURST = (4, 3, 3)
MATCH_BUFFER_SECONDS = 300
TOLERANCE_SECONDS = 3600
N_TRACKS = 175
PAGE_SIZE = 2000
TAG_BATCH = 2000
AOI_MARGIN_DEGREES = 0.25
MAX_REPORT_ROWS = 50_000
MAX_POPUP_ROWS = 12
EARTH = (-180.0, -90.0, 180.0, 90.0)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
