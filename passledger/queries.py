"""Every audit as a query on the test tables, and the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passledger import fixtures as fx
from passledger.functions import ids, times
from passledger.functions.geometry import wkt_rounded
from passledger.operators import aoi, checks, coverage, dedup, enumerate, inputs_audit
from passledger.operators.frame import build_input_frame, left_out, with_burst_geometry, with_tile_geometry
from passledger.plans import sections
from passledger.sources import granules
from passledger.sources.tags import to_fetch

AOI = (-150.0, -60.0, -120.5, -30.0)


def _texts(df: DataFrame) -> DataFrame:
    """Times as text, arrays joined."""
    for name, kind in df.dtypes:
        if kind.startswith("timestamp"):
            df = df.withColumn(name, F.date_format(name, "yyyy-MM-dd HH:mm:ss"))
        elif kind.startswith("array"):
            df = df.withColumn(name, F.array_join(F.transform(name, lambda x: x.cast("string")), ","))
    return df


def _dedup(spark, d):
    return dedup.deduplicate_products(fx.products(spark, d))


def _groups(spark, d):
    return coverage.expected_pass_groups(fx.frame(spark, d), fx.START, fx.STOP)


def _coverage(spark, d):
    return coverage.check_coverage(_groups(spark, d), _dedup(spark, d), fx.frame(spark, d))


def _expected(spark, d):
    return fx.expected(spark, d)


def _audit(spark, d):
    return inputs_audit.check_inputs(fx.tags(spark, d), fx.frame(spark, d), fx.expected(spark, d))


def id_parse(spark, d):
    p = fx.products(spark, d).select("opera_id")
    return p.select("opera_id", ids.truncated("opera_id").alias("trunc"), ids.tile_id("opera_id").alias("tile"), ids.acquisition_time_naive("opera_id").alias("acq"), ids.processing_time_naive("opera_id").alias("proc"), ids.satellite("opera_id").alias("sat"))


def input_id_parse(spark, d):
    g = fx.raw_inputs(spark, d).select("opera_id").distinct()
    return g.select("opera_id", ids.burst_id("opera_id").alias("burst"), ids.track_number(ids.burst_id("opera_id")).alias("track"), ids.acquisition_time("opera_id").alias("acq"))


def confirmation(spark, d, strict: bool = False):
    return checks.check_confirmation(_dedup(spark, d), fx.tags(spark, d), strict).drop("alert_url")


def confirmation_tiles(spark, d):
    tags = fx.tags(spark, d)
    own = checks.check_confirmation(_dedup(spark, d), tags).join(tags.select("opera_id"), "opera_id", "left_semi")
    return checks.summarize_by_tile(own.withColumn("fail", ~F.col("confirmed_ok")), "fail")


def rtc_dedup(spark, d):
    return fx.inputs(spark, d).select("opera_id", "jpl_burst_id", "acq_dt", "processing_dt", "track_number", "polarizations")


def rtc_frame(spark, d):
    return fx.frame(spark, d).select("opera_id", "mgrs_tile_id", "pass_id", "acq_group_id_within_mgrs_tile", "track_token")


def baseline_counts(spark, d):
    frame = fx.frame(spark, d)
    return coverage.baseline_counts(coverage.expected_pass_groups(frame, fx.START, fx.STOP), frame)


def parse_inputs(spark, d):
    return inputs_audit.parse_actual_inputs(fx.tags(spark, d)).select("product", "input_id", "input_category", "place", "opera_id_trunc", "jpl_burst_id", "track_number", "acq_dt")


def _polarizations(spark, d, granules: DataFrame):
    """Granules of each tile up to 1996 as pre inputs of one product, later ones as post inputs, with
    polarizations of all granules, single-polarized ones too."""
    pols = inputs_audit.polarization_map(fx.inputs(spark, d), [])
    listed = lambda own: F.array_join(F.array_sort(F.collect_list(F.when(own, F.col("opera_id")))), ",")
    early = F.coalesce(F.year("acq_dt") <= 1996, F.lit(False))
    own = granules.groupBy("n").agg(listed(early).alias("pre_rtc_opera_ids"), listed(~early).alias("post_rtc_opera_ids"))
    tags = own.select(F.concat(F.lit("P"), F.col("n").cast("string")).alias("opera_id"), F.col("n").cast("string").alias("mgrs_tile_id"), "pre_rtc_opera_ids", "post_rtc_opera_ids")
    found = inputs_audit.polarization_issues(inputs_audit.parse_actual_inputs(tags), pols, [])
    return found.select("product", F.md5(F.col("single_text").cast("binary")).alias("single_md5"), F.md5(F.col("mismatch_text").cast("binary")).alias("mismatch_md5"))


def polarization_issues(spark, d):
    """Of granules up to 1997 only, as its SQL has it; `polarization_issues_all` leaves none out."""
    return _polarizations(spark, d, fx.inputs(spark, d).where(F.year("acq_dt") <= 1997))


def polarization_issues_all(spark, d):
    return _polarizations(spark, d, fx.inputs(spark, d))


def product_match(spark, d):
    index = enumerate.expected_index(fx.expected(spark, d))
    summary = inputs_audit.actual_summary(inputs_audit.parse_actual_inputs(fx.tags(spark, d)), ("product", "mgrs_tile_id"))
    return inputs_audit.match_expected(summary.select("product", "mgrs_tile_id", "tracks", "post_min"), index).select("product", "product_id")


def aoi_products(spark, d):
    return aoi.products_over_aoi(fx.products(spark, d), AOI, "1995-01-01", "1999-01-01").select("opera_id", "mgrs_tile_id")


def target_tiles(spark, d):
    found, box = aoi.resolve_target_tiles(fx.tiles(spark, d), fx.lut(spark, d), fx.bursts(spark, d), AOI)
    return found.crossJoin(F.broadcast(box))  # one row


def resume_todo(spark, d):
    """Every third product has results from before; those that could not be read are tried again."""
    tags = fx.tags(spark, d)
    number = F.substring(F.substring_index("opera_id", "_", -1), 2, 20).cast("long")
    done = tags.where(number % 3 == 0).select("opera_id", F.when(F.col("error") == "", F.lit("")).otherwise(F.lit(inputs_audit.UNREAD)).alias("issue_type"))
    return inputs_audit.resume(tags, done, retry_errors=True).select("opera_id", "mgrs_tile_id")


def rtc_inputs_urls(spark, d):
    pols = inputs_audit.polarization_map(fx.inputs(spark, d), [])
    return aoi.recorded_inputs(fx.tags(spark, d), fx.BASE_URL, pols)


def tile_features(spark, d):
    bad = checks.check_duplicates(fx.products(spark, d))
    features = sections.tile_features(bad, fx.products(spark, d).select("mgrs_tile_id", "geometry").distinct(), most=3, order=["acq_time", "opera_id"])
    return features.select("mgrs_tile_id", "n_failures", F.array_join(F.transform("rows", lambda r: r["opera_id"]), ",").alias("shown"))


def frame_of_tiles(spark, d):
    frame = build_input_frame(fx.inputs(spark, d).drop("n"), fx.lut(spark, d), _sampled_tiles(spark, d))
    return frame.select("opera_id", "mgrs_tile_id", "pass_id", "acq_group_id_within_mgrs_tile", "track_token")


def _sampled_tiles(spark, d):
    return aoi.sample_rows(fx.products(spark, d).select("mgrs_tile_id").distinct(), 5, "mgrs_tile_id")


def tags_todo(spark, d):
    """Tags of every third product are there, half of them as errors, which are tried again."""
    p = fx.products(spark, d)
    number = F.substring("sat", 2, 20).cast("long")
    have = p.where(number % 3 == 0).select("opera_id", F.when(number % 2 == 0, "").otherwise("OSError: unreadable").alias("error"))
    return to_fetch(p, have)


def input_items(spark, d):
    return granules.parse_inputs(fx.input_items(spark, d)).drop("opera_dedup_id")


def search_links(spark, d):
    rows = fx.shapes_at(spark, d)
    return rows.select("opera_id", aoi.search_url(F.col("geometry"), F.col("acq_time"), "https://search.example.org/").alias("search_url"))


def _section(spark, made):
    """What a section says of its check, as one row; all of its rows are counted, `n_shown` of them are in the report."""
    (s,), _ = made
    row = (s.key, s.n_checked, s.n_failures, s.truncated, len(s.records), len(s.features))
    return spark.createDataFrame([row], "key string, n_checked long, n_failures long, truncated boolean, n_shown long, n_tiles long")


def _plain(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _texts(f(spark, sf_dir))

    return query


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "id_parse": id_parse,
    "input_id_parse": input_id_parse,
    "dedup_latest": lambda s, d: _dedup(s, d).select("opera_id", "mgrs_tile_id", "acq_time", "processing_time", "n_versions"),
    "duplicates": lambda s, d: checks.check_duplicates(fx.products(s, d)),
    "processing_order": lambda s, d: checks.check_processing_order(_dedup(s, d)),
    "confirmation": confirmation,
    "confirmation_strict": lambda s, d: confirmation(s, d, True),
    "confirmation_tiles": confirmation_tiles,
    "recent_per_tile": lambda s, d: checks.recent_per_tile(_dedup(s, d), 10).select("opera_id", "mgrs_tile_id", "acq_time"),
    "rtc_dedup": rtc_dedup,
    "rtc_frame": rtc_frame,
    "pass_groups": _groups,
    "coverage": _coverage,
    "coverage_no_baseline": lambda s, d: coverage.check_coverage(_groups(s, d), _dedup(s, d)).withColumn("n_bursts_with_baseline", F.col("n_bursts_with_baseline").cast("long")),
    "coverage_missing": lambda s, d: coverage.missing_passes(_coverage(s, d)),
    "coverage_missing_by_tile": lambda s, d: coverage.missing_by_tile(coverage.missing_passes(_coverage(s, d))),
    "baseline_counts": baseline_counts,
    "orphans": lambda s, d: coverage.check_orphans(_groups(s, d), _dedup(s, d)),
    "expected_products": _expected,
    "expected_index": lambda s, d: enumerate.expected_index(_expected(s, d)),
    "parse_inputs": parse_inputs,
    "polarization_issues": polarization_issues,
    "polarization_issues_all": polarization_issues_all,
    "product_match": product_match,
    "inputs_audit": _audit,
    "issue_summary": lambda s, d: inputs_audit.issue_summary(inputs_audit.incorrect(_audit(s, d))),
    "inputs_pre": lambda s, d: inputs_audit.pre_issues(inputs_audit.incorrect(_audit(s, d))),
    "inputs_post": lambda s, d: inputs_audit.post_issues(inputs_audit.incorrect(_audit(s, d))),
    "lookback_ranges": lambda s, d: aoi.lookback_ranges(s, fx.START, fx.STOP),
    "date_chunks": lambda s, d: aoi.date_chunk_table(s, fx.START, fx.STOP, 7),
    "aoi_products": aoi_products,
    "target_tiles": target_tiles,
    "sample_tiles": lambda s, d: aoi.sample_tiles(fx.products(s, d), 5).select("opera_id", "mgrs_tile_id"),
    "resume_todo": resume_todo,
    "rtc_inputs_urls": rtc_inputs_urls,
    "tile_features": tile_features,
    "ids_of_urls": lambda s, d: fx.products(s, d).select("opera_id", ids.id_from_url("alert_url").alias("url_id")),
    "input_counts": lambda s, d: inputs_audit.input_counts(inputs_audit.parse_actual_inputs(fx.tags(s, d))),
    "tile_totals": lambda s, d: aoi.tile_totals(fx.products(s, d)),
    "left_out": lambda s, d: left_out(fx.inputs(s, d)),
    "product_geometry": lambda s, d: with_tile_geometry(fx.products(s, d), fx.tile_shapes(s, d)).select("opera_id", "mgrs_tile_id", "geometry"),
    "input_geometry": lambda s, d: with_burst_geometry(fx.inputs(s, d), fx.burst_shapes(s, d)).select("opera_id", "jpl_burst_id", "geometry"),
    "tile_outlines": lambda s, d: fx.fine_outlines(s, d).select("mgrs_tile_id", wkt_rounded(F.col("geometry")).alias("outline")),
    "frame_of_tiles": frame_of_tiles,
    "expected_of_tiles": lambda s, d: enumerate.build_expected_products(fx.frame(s, d), _sampled_tiles(s, d)),
    "tags_todo": tags_todo,
    "product_items": lambda s, d: granules.parse_products(fx.product_items(s, d)),
    "input_items": input_items,
    "search_links": search_links,
    "section_duplicates": lambda s, d: _section(s, sections.duplicates_section(fx.products(s, d), fx.tile_shapes(s, d))),
    "section_ordering": lambda s, d: _section(s, sections.ordering_section(_dedup(s, d), fx.tile_shapes(s, d))),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _plain(f) for name, f in _QUERIES.items()}


# ---- the same in SQL

_TABLES = r"""
products AS (
  SELECT 'FX_L3_ALERT_T' || tile || '_' || strftime(acq_time, '%Y%m%dT%H%M%SZ') || '_' || strftime(processing_time, '%Y%m%dT%H%M%SZ') || '_' || sat AS opera_id,
    tile AS mgrs_tile_id, acq_time, processing_time, sat, k, n, 'FX_L3_ALERT_T' || tile || '_' || strftime(acq_time, '%Y%m%dT%H%M%SZ') AS opera_dedup_id
  FROM (SELECT lpad(CAST(o_custkey // 4 AS VARCHAR), 5, '0') AS tile, o_custkey // 4 AS n, o_orderkey AS k, o_orderdate AS acq_time, 'S' || o_orderkey AS sat,
      o_orderdate + to_seconds(21600 + 540 * (o_orderkey % 97) + CASE WHEN o_orderkey % 37 = 0 THEN 7776000 ELSE 0 END) AS processing_time
    FROM orders WHERE o_orderkey % 11 <> 0)
),
purl AS (SELECT *, CASE WHEN k % 41 <> 0 THEN 'https://data.example.org/products/' || opera_id || '/' || opera_id || '_STATUS.tif' END AS alert_url FROM products),
dedup AS (
  SELECT * EXCLUDE nth FROM (SELECT *, count(*) OVER (PARTITION BY opera_dedup_id) AS n_versions,
    row_number() OVER (PARTITION BY opera_dedup_id ORDER BY processing_time DESC, opera_id DESC) AS nth FROM purl) WHERE nth = 1
),
raw AS (
  SELECT DISTINCT 'FX_L2_RTC_' || burst || '_' || strftime(acq, '%Y%m%dT%H%M%SZ') || '_' || strftime(acq + to_seconds(10800 + k), '%Y%m%dT%H%M%SZ') || '_S1A' AS opera_id,
    burst AS jpl_burst_id, acq AS acq_dt, acq + to_seconds(10800 + k) AS processing_dt, track AS track_number, pol AS polarizations,
    'FX_L2_RTC_' || burst || '_' || strftime(acq, '%Y%m%dT%H%M%SZ') AS did, k % 53 <> 0 AS located, n
  FROM (SELECT o_orderkey AS k, o_custkey // 4 AS n, CAST(1 + (o_custkey // 4) % 175 AS INTEGER) AS track,
      'T' || lpad(CAST(1 + (o_custkey // 4) % 175 AS VARCHAR), 3, '0') || '-' || lpad(CAST(o_custkey // 4 AS VARCHAR), 6, '0') || '-IW' || (1 + l_linenumber % 3) AS burst,
      o_orderdate + to_seconds(3 * l_linenumber) AS acq,
      CASE WHEN (o_orderkey + l_linenumber) % 10 = 0 THEN 'VV' WHEN o_orderkey % 3 = 0 THEN 'HH+HV' ELSE 'VV+VH' END AS pol
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
),
granules AS (
  SELECT * EXCLUDE nth FROM (SELECT *, row_number() OVER (PARTITION BY did ORDER BY processing_dt DESC, opera_id DESC) AS nth FROM raw) WHERE nth = 1
),
lut AS (
  SELECT DISTINCT jpl_burst_id, lpad(CAST(n AS VARCHAR), 5, '0') AS mgrs_tile_id FROM granules
  UNION SELECT jpl_burst_id, lpad(CAST(n + 1 AS VARCHAR), 5, '0') FROM granules WHERE jpl_burst_id LIKE '%-IW1'
),
frame AS (
  SELECT g.*, mgrs_tile_id, date_diff('day', DATE '1970-01-01', CAST(acq_dt AS DATE)) AS pass_id, track_number AS grp, CAST(track_number AS VARCHAR) AS track_token
  FROM granules g JOIN lut USING (jpl_burst_id) WHERE located AND polarizations IN ('VV+VH', 'HH+HV')
),
grps AS (
  SELECT mgrs_tile_id, grp, pass_id, min(acq_dt) AS post_acq_dt, count(DISTINCT jpl_burst_id) AS n_bursts, min(track_token) AS track_token,
    list_sort(list(DISTINCT jpl_burst_id)) AS burst_ids, list_sort(list(DISTINCT jpl_burst_id || '|' || polarizations)) AS burst_pols
  FROM frame GROUP BY ALL HAVING min(acq_dt) >= TIMESTAMP '1999-01-01' AND min(acq_dt) < TIMESTAMP '2001-01-01'
),
win AS (SELECT unnest([0, 1, 2]) AS w, unnest([365, 730, 1095]) AS days, unnest([4, 3, 3]) AS cap),
based AS (
  SELECT mgrs_tile_id, grp, pass_id, count(*) AS n FROM (SELECT mgrs_tile_id, grp, pass_id, post_acq_dt, unnest(burst_pols) AS bp FROM grps) g
  WHERE EXISTS (SELECT 1 FROM frame f, win WHERE f.jpl_burst_id || '|' || f.polarizations = bp AND f.acq_dt < post_acq_dt - to_days(days) AND f.acq_dt >= post_acq_dt - to_days(days + 60))
  GROUP BY ALL
),
near AS (
  SELECT * EXCLUDE nth FROM (SELECT g.mgrs_tile_id, g.grp, g.pass_id, d.opera_id, abs(epoch_us(d.acq_time) - epoch_us(g.post_acq_dt)) / 1e6 AS diff,
    row_number() OVER (PARTITION BY g.mgrs_tile_id, g.grp, g.pass_id ORDER BY abs(epoch_us(d.acq_time) - epoch_us(g.post_acq_dt)), d.acq_time, d.opera_id) AS nth
    FROM grps g JOIN dedup d USING (mgrs_tile_id)) WHERE nth = 1 AND diff <= 3600
),
cov AS (
  SELECT g.mgrs_tile_id, g.track_token, g.post_acq_dt, g.pass_id, g.n_bursts, near.opera_id IS NOT NULL AS product_found, coalesce(near.opera_id, '') AS matched_opera_id, diff AS time_diff_seconds,
    CASE WHEN near.opera_id IS NULL THEN coalesce(based.n, 0) END AS nb
  FROM grps g LEFT JOIN near USING (mgrs_tile_id, grp, pass_id) LEFT JOIN based USING (mgrs_tile_id, grp, pass_id)
),
coverage AS (
  SELECT mgrs_tile_id, track_token, post_acq_dt, pass_id, n_bursts, product_found, matched_opera_id, time_diff_seconds, nb AS n_bursts_with_baseline, coalesce(nb > 0, FALSE) AS missing_product_expected,
    CASE WHEN product_found THEN '' ELSE 'no output product for RTC pass at ' || strftime(post_acq_dt, '%Y-%m-%d %H:%M:%S') || '+00:00 (' ||
      CASE WHEN nb > 0 THEN nb || '/' || n_bursts || ' bursts have baseline imagery' ELSE 'no baseline imagery; product not expected' END || ')' END AS reason FROM cov
),
first_post AS (SELECT mgrs_tile_id, grp, pass_id, min(acq_dt) AS post_min FROM frame GROUP BY ALL),
pre AS (
  SELECT DISTINCT mgrs_tile_id, grp, pass_id, jpl_burst_id, polarizations, opera_id, track_number, acq_dt FROM (
    SELECT p.*, f.opera_id, f.track_number, f.acq_dt, cap, row_number() OVER (PARTITION BY p.mgrs_tile_id, p.grp, p.pass_id, p.jpl_burst_id, p.polarizations, w ORDER BY f.acq_dt DESC, f.opera_id DESC) AS nth
    FROM (SELECT DISTINCT mgrs_tile_id, grp, pass_id, jpl_burst_id, polarizations, post_min FROM frame JOIN first_post USING (mgrs_tile_id, grp, pass_id)) p
    CROSS JOIN win JOIN frame f ON f.mgrs_tile_id = p.mgrs_tile_id AND f.jpl_burst_id = p.jpl_burst_id AND f.polarizations = p.polarizations
      AND f.acq_dt < post_min - to_days(days) AND f.acq_dt >= post_min - to_days(days + 60)) WHERE nth <= cap
),
expected AS (
  SELECT mgrs_tile_id || '/' || grp || '/' || pass_id AS product_id, mgrs_tile_id, c AS input_category, opera_id, array_to_string(string_split(opera_id, '_')[1:5], '_') AS opera_id_trunc, jpl_burst_id, polarizations, track_number, acq_dt
  FROM (SELECT *, 'pre' AS c FROM pre UNION ALL BY NAME SELECT mgrs_tile_id, grp, pass_id, jpl_burst_id, polarizations, opera_id, track_number, acq_dt, 'post' AS c FROM frame
    SEMI JOIN pre USING (mgrs_tile_id, grp, pass_id, jpl_burst_id, polarizations))
),
idx AS (SELECT mgrs_tile_id, product_id, min(acq_dt) AS post_min_dt, list_sort(list(DISTINCT track_number)) AS track_numbers FROM expected WHERE input_category = 'post' GROUP BY ALL),
own AS (SELECT product_id, list_sort(coalesce(list(DISTINCT opera_id) FILTER (input_category = 'pre'), [])) AS pre, list_sort(coalesce(list(DISTINCT opera_id) FILTER (input_category = 'post'), [])) AS post FROM expected GROUP BY ALL),
chain AS (
  SELECT *, coalesce(CASE WHEN k % 23 = 0 THEN lag(opera_id, 2) OVER w ELSE lag(opera_id, 1) OVER w END, '') AS prior,
    mgrs_tile_id || '/' || (1 + CAST(mgrs_tile_id AS INTEGER) % 175) || '/' || date_diff('day', DATE '1970-01-01', CAST(acq_time AS DATE)) AS product_id
  FROM dedup WINDOW w AS (PARTITION BY mgrs_tile_id ORDER BY acq_time, opera_id)
),
planted AS (
  SELECT c.*, CASE WHEN prior <> '' AND k % 5 = 0 THEN 'some/folder/' || prior ELSE prior END AS prior_product,
    CASE WHEN k % 13 = 0 AND len(coalesce(pre, [])) > 0 THEN pre[2:] ELSE coalesce(pre, []) END AS pre1, CASE WHEN k % 19 = 0 AND len(coalesce(post, [])) > 1 THEN post[:-2] ELSE coalesce(post, []) END AS post1
  FROM chain c LEFT JOIN own USING (product_id) WHERE k % 29 <> 0
),
tags AS (
  SELECT opera_id, CASE WHEN k % 31 = 0 THEN 'OSError: unreadable' ELSE '' END AS error, mgrs_tile_id,
    CASE WHEN k % 31 = 0 THEN '' ELSE array_to_string(list_concat(pre1, CASE WHEN k % 43 = 0 THEN ['FX_L2_RTC_T002-000001-IW1_19980101T000000Z_19980102T000000Z_S1A'] ELSE [] END), ',') END AS pre_rtc_opera_ids,
    CASE WHEN k % 31 = 0 THEN '' ELSE array_to_string(list_concat(list_concat(post1, CASE WHEN k % 47 = 0 AND len(post1) > 0 THEN ['FX_L2_RTC_T009-000001-IW2_' || strftime(acq_time + to_seconds(270000), '%Y%m%dT%H%M%SZ') || '_20020101T000000Z_S1A'] ELSE [] END),
      CASE WHEN k % 59 = 0 THEN ['bad_id'] ELSE [] END), ',') END AS post_rtc_opera_ids,
    CASE WHEN k % 31 = 0 THEN '' ELSE prior_product END AS prior_product
  FROM planted
),
conf AS (
  SELECT d.opera_id, d.mgrs_tile_id, d.acq_time, d.processing_time, coalesce(nullif(string_split(coalesce(prior_product, ''), '/')[-1], ''), 'None') AS prior_used,
    coalesce(lag(d.opera_id) OVER (PARTITION BY d.mgrs_tile_id ORDER BY d.acq_time, d.opera_id), 'None') AS prior_expected, error IS NULL OR error <> '' OR prior_product IS NULL AS tag_missing
  FROM dedup d LEFT JOIN tags t ON d.opera_id = t.opera_id
),
conf2 AS (
  SELECT *, prior_expected = 'None' AS is_first_in_window, bool_or(tag_missing) OVER (PARTITION BY mgrs_tile_id) AS tile_incomplete,
    array_to_string(string_split(prior_used, '_')[1:5], '_') = array_to_string(string_split(prior_expected, '_')[1:5], '_') AS agrees FROM conf
),
actual AS (
  SELECT product, mgrs_tile_id, input_id, input_category, CAST(i - 1 AS INTEGER) AS place, array_to_string(string_split(input_id, '_')[1:5], '_') AS opera_id_trunc,
    string_split(input_id, '_')[4] AS jpl_burst_id, TRY_CAST(string_split(string_split(input_id, '_')[4], '-')[1][2:] AS INTEGER) AS track_number, try_strptime(string_split(input_id, '_')[5], '%Y%m%dT%H%M%SZ') AS acq_dt
  FROM (SELECT product, mgrs_tile_id, input_category, unnest(l) AS input_id, unnest(range(1, len(l) + 1)) AS i FROM (
    SELECT opera_id AS product, mgrs_tile_id, 'pre' AS input_category, list_filter(string_split(pre_rtc_opera_ids, ','), lambda x: x <> '') AS l FROM tags
    UNION ALL SELECT opera_id, mgrs_tile_id, 'post', list_filter(string_split(post_rtc_opera_ids, ','), lambda x: x <> '') FROM tags))
),
summ AS (
  SELECT product, list_sort(coalesce(list(DISTINCT opera_id_trunc) FILTER (input_category = 'pre'), [])) AS pre_ids, list_sort(coalesce(list(DISTINCT opera_id_trunc) FILTER (input_category = 'post'), [])) AS post_ids,
    list_sort(coalesce(list(DISTINCT jpl_burst_id) FILTER (jpl_burst_id IS NOT NULL), [])) AS bursts, list_sort(coalesce(list(DISTINCT track_number) FILTER (track_number IS NOT NULL), [])) AS tracks,
    min(acq_dt) FILTER (input_category = 'post') AS post_min, max(acq_dt) FILTER (input_category = 'post') AS post_max,
    max(input_id) FILTER (jpl_burst_id IS NULL OR track_number IS NULL OR acq_dt IS NULL) AS broken_id FROM actual GROUP BY product
),
ok AS (SELECT t.opera_id AS product, t.mgrs_tile_id FROM tags t WHERE error = '' AND mgrs_tile_id IN (SELECT mgrs_tile_id FROM frame)),
prods AS (SELECT product, mgrs_tile_id, coalesce(pre_ids, []) AS pre_ids, coalesce(post_ids, []) AS post_ids, coalesce(bursts, []) AS bursts, coalesce(tracks, []) AS tracks, post_min, post_max, broken_id FROM ok LEFT JOIN summ USING (product)),
matches AS (
  SELECT product, min(product_id) AS product_id FROM (SELECT DISTINCT product, mgrs_tile_id FROM actual) JOIN summ USING (product) JOIN idx USING (mgrs_tile_id)
  WHERE abs(epoch_us(post_min) - epoch_us(post_min_dt)) < 300000000 AND list_has_any(tracks, track_numbers) GROUP BY product HAVING count(*) = 1
),
pols AS (SELECT mgrs_tile_id, did AS opera_id_trunc, arg_max(polarizations, (acq_dt, opera_id)) AS pol FROM frame GROUP BY ALL),
apol AS (SELECT a.*, pol, CASE WHEN input_category = 'pre' THEN 0 ELSE 1 END AS c FROM actual a JOIN pols USING (mgrs_tile_id, opera_id_trunc)),
ppol AS (SELECT product, jpl_burst_id, arg_max(pol, place) AS post_pol FROM apol WHERE input_category = 'post' GROUP BY ALL),
polis AS (
  SELECT product, coalesce(string_agg(opera_id_trunc || '=' || pol, ';' ORDER BY c, place) FILTER (pol NOT IN ('VV+VH', 'HH+HV')), '') AS single_text,
    coalesce(string_agg(opera_id_trunc || '=' || pol || ' vs post-image ' || post_pol, ';' ORDER BY c, place) FILTER (c = 0 AND pol <> post_pol), '') AS mismatch_text
  FROM apol LEFT JOIN ppol USING (product, jpl_burst_id) GROUP BY product
),
esets AS (SELECT product_id, coalesce(list(DISTINCT opera_id_trunc) FILTER (input_category = 'pre'), []) AS exp_pre, coalesce(list(DISTINCT opera_id_trunc) FILTER (input_category = 'post'), []) AS exp_post, list_sort(list(DISTINCT jpl_burst_id)) AS exp_bursts FROM expected GROUP BY ALL),
cmp AS (SELECT * FROM prods JOIN matches USING (product) JOIN esets USING (product_id) LEFT JOIN polis USING (product) WHERE broken_id IS NULL),
found_issues AS (
  SELECT product, mgrs_tile_id, unnest([
    CASE WHEN single_text <> '' THEN {'t': 'Single polarization input used', 'v': single_text} END,
    CASE WHEN mismatch_text <> '' THEN {'t': 'Pre RTC baseline polarization mismatch', 'v': mismatch_text} END,
    CASE WHEN len(tracks) > 2 OR len(tracks) = 2 AND abs(tracks[1] - tracks[2]) NOT IN (1, 174) THEN {'t': 'Too many track numbers present', 'v': '[' || array_to_string(tracks, ', ') || ']'} END,
    CASE WHEN epoch_us(post_max) - epoch_us(post_min) >= 2 * 86400000000 THEN {'t': 'Post-dates span too long', 'v': ((epoch_us(post_max) - epoch_us(post_min)) // 86400000000) || ' days ' || strftime(TIMESTAMP '2000-01-01' + to_microseconds((epoch_us(post_max) - epoch_us(post_min)) % 86400000000), '%H:%M:%S')} END,
    CASE WHEN exp_bursts <> bursts THEN {'t': 'Burst ID mismatch', 'v': 'expected=[' || array_to_string(list_transform(exp_bursts, lambda x: '''' || x || ''''), ', ') || ']; found=[' || array_to_string(list_transform(bursts, lambda x: '''' || x || ''''), ', ') || ']'} END,
    {'t': 'Pre RTC IDs expected but not found', 'v': array_to_string(list_sort(list_filter(exp_pre, lambda x: NOT list_contains(pre_ids, x))), ';')},
    {'t': 'Pre RTC IDs found but not expected', 'v': array_to_string(list_sort(list_filter(pre_ids, lambda x: NOT list_contains(exp_pre, x))), ';')},
    {'t': 'Post RTC IDs expected but not found', 'v': array_to_string(list_sort(list_filter(exp_post, lambda x: NOT list_contains(post_ids, x))), ';')},
    {'t': 'Post RTC IDs found but not expected', 'v': array_to_string(list_sort(list_filter(post_ids, lambda x: NOT list_contains(exp_post, x))), ';')}
  ]) AS i FROM cmp
),
issues AS (SELECT product, mgrs_tile_id, i.t AS issue_type, i.v AS issue_value FROM found_issues WHERE i IS NOT NULL AND i.v <> ''),
audit AS (
  SELECT opera_id, mgrs_tile_id, CAST(NULL AS BOOLEAN) AS inputs_correct, 'Tag read error' AS issue_type, error AS issue_value FROM tags WHERE error <> ''
  UNION ALL SELECT opera_id, mgrs_tile_id, FALSE, 'No expected product found', 'tile=' || mgrs_tile_id || ' absent from RTC table' FROM tags WHERE error = '' AND mgrs_tile_id NOT IN (SELECT mgrs_tile_id FROM frame)
  UNION ALL SELECT product, mgrs_tile_id, NULL, 'Enumeration error', 'ValueError: cannot parse input id ' || broken_id FROM prods WHERE broken_id IS NOT NULL
  UNION ALL SELECT product, mgrs_tile_id, FALSE, 'No expected product found', 'tile=' || mgrs_tile_id || '; tracks=[' || array_to_string(tracks, ', ') || ']; post=' || coalesce(strftime(post_min, '%Y-%m-%d %H:%M:%S') || '+00:00', 'NaT')
    FROM prods WHERE broken_id IS NULL AND product NOT IN (SELECT product FROM matches)
  UNION ALL SELECT product, mgrs_tile_id, FALSE, issue_type, issue_value FROM issues
  UNION ALL SELECT product, mgrs_tile_id, TRUE, '', '' FROM cmp WHERE product NOT IN (SELECT product FROM issues)
)
"""

_T = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
_DUP = f"""
SELECT opera_id, mgrs_tile_id, {_T.format('acq_time')}, {_T.format('processing_time')}, n_versions, is_latest, latest_opera_id, reprocessing_lag_hours,
  n_versions || ' granules share acquisition ' || opera_dedup_id || '; ' || CASE WHEN is_latest THEN 'latest, kept' ELSE 'superseded by ' || latest_opera_id END AS reason, alert_url
FROM (SELECT *, count(*) OVER p AS n_versions, last(opera_id) OVER o AS latest_opera_id, opera_id = last(opera_id) OVER o AS is_latest, (epoch_us(processing_time) - min(epoch_us(processing_time)) OVER p) / 3.6e9 AS reprocessing_lag_hours
  FROM purl WINDOW p AS (PARTITION BY opera_dedup_id), o AS (PARTITION BY opera_dedup_id ORDER BY processing_time, opera_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) WHERE n_versions > 1
"""
_CONF = """
SELECT opera_id, mgrs_tile_id, strftime(acq_time, '%Y-%m-%d %H:%M:%S') AS acq_time, strftime(processing_time, '%Y-%m-%d %H:%M:%S') AS processing_time, prior_used, prior_expected, is_first_in_window, tag_missing, tile_incomplete, confirmed_ok,
  CASE WHEN tag_missing THEN 'could not read prior product tag' WHEN NOT confirmed_ok THEN 'prior product used: ' || prior_used || '; expected: ' || prior_expected ELSE '' END AS reason
FROM (SELECT *, NOT tag_missing AND (agrees{0}) AS confirmed_ok FROM conf2)
"""
_COV = f"mgrs_tile_id, track_token, {_T.format('post_acq_dt')}, pass_id, n_bursts, product_found, matched_opera_id, time_diff_seconds, n_bursts_with_baseline, missing_product_expected, reason"

_SELECTS = {
    "id_parse": "SELECT opera_id, opera_dedup_id AS trunc, mgrs_tile_id AS tile, strftime(acq_time, '%Y-%m-%d %H:%M:%S') AS acq, strftime(processing_time, '%Y-%m-%d %H:%M:%S') AS proc, sat FROM products",
    "input_id_parse": "SELECT opera_id, jpl_burst_id AS burst, track_number AS track, strftime(acq_dt, '%Y-%m-%d %H:%M:%S') AS acq FROM raw",
    "dedup_latest": f"SELECT opera_id, mgrs_tile_id, {_T.format('acq_time')}, {_T.format('processing_time')}, n_versions FROM dedup",
    "duplicates": _DUP,
    "processing_order": f"""
SELECT opera_id, mgrs_tile_id, {_T.format('acq_time')}, {_T.format('processing_time')}, prev_opera_id, {_T.format('prev_acq_time')}, {_T.format('prev_processing_time')}, lag_h AS processing_lag_hours, n_versions > 1 AS is_reprocessed,
  prev_opera_id IS NOT NULL AS evaluated, coalesce(lag_h < 0, FALSE) AS out_of_order, CASE WHEN lag_h < 0 THEN 'processed ' || printf('%.1f', -lag_h) || ' h before the previous acquisition in the tile (' || prev_opera_id || ')' ELSE '' END AS reason, alert_url
FROM (SELECT *, (epoch_us(processing_time) - epoch_us(prev_processing_time)) / 3.6e9 AS lag_h FROM (
  SELECT *, lag(opera_id) OVER w AS prev_opera_id, lag(acq_time) OVER w AS prev_acq_time, lag(processing_time) OVER w AS prev_processing_time FROM dedup WHERE n_versions = 1 WINDOW w AS (PARTITION BY mgrs_tile_id ORDER BY acq_time, opera_id)
  UNION ALL SELECT *, NULL, NULL, NULL FROM dedup WHERE n_versions > 1))
""",
    "confirmation": _CONF.format(" OR is_first_in_window"),
    "confirmation_strict": _CONF.format(""),
    "confirmation_tiles": """
SELECT mgrs_tile_id, count(*) AS n_products, count(*) FILTER (NOT good) AS n_failures, bool_and(good) AS ok, coalesce(string_agg(opera_id, ';' ORDER BY acq_time, opera_id) FILTER (NOT good), '') AS bad_opera_ids
FROM (SELECT *, NOT tag_missing AND (agrees OR is_first_in_window) AS good FROM conf2 SEMI JOIN tags USING (opera_id)) GROUP BY mgrs_tile_id
""",
    "recent_per_tile": f"SELECT opera_id, mgrs_tile_id, {_T.format('acq_time')} FROM (SELECT *, row_number() OVER (PARTITION BY mgrs_tile_id ORDER BY acq_time DESC, opera_id DESC) AS nth FROM dedup) t WHERE nth = 1 ORDER BY t.acq_time DESC, opera_id DESC LIMIT 10",
    "rtc_dedup": f"SELECT opera_id, jpl_burst_id, {_T.format('acq_dt')}, {_T.format('processing_dt')}, track_number, polarizations FROM granules",
    "rtc_frame": "SELECT opera_id, mgrs_tile_id, pass_id, grp AS acq_group_id_within_mgrs_tile, track_token FROM frame",
    "pass_groups": f"SELECT mgrs_tile_id, grp AS acq_group_id_within_mgrs_tile, pass_id, {_T.format('post_acq_dt')}, n_bursts, track_token, array_to_string(burst_ids, ',') AS burst_ids, array_to_string(burst_pols, ',') AS burst_pols FROM grps",
    "coverage": f"SELECT {_COV} FROM coverage",
    "coverage_no_baseline": f"""
SELECT mgrs_tile_id, track_token, {_T.format('post_acq_dt')}, pass_id, n_bursts, product_found, matched_opera_id, time_diff_seconds, CAST(NULL AS BIGINT) AS n_bursts_with_baseline, NOT product_found AS missing_product_expected,
  CASE WHEN product_found THEN '' ELSE 'no output product for RTC pass at ' || strftime(cov.post_acq_dt, '%Y-%m-%d %H:%M:%S') || '+00:00 (baseline not checked (no lookback RTC metadata))' END AS reason FROM cov
""",
    "coverage_missing": f"SELECT {_COV} FROM coverage WHERE NOT product_found AND missing_product_expected",
    "coverage_missing_by_tile": "SELECT mgrs_tile_id, count(*) AS n_missing, string_agg(strftime(post_acq_dt, '%Y-%m-%d'), ';' ORDER BY post_acq_dt) AS missing_post_dates FROM coverage WHERE NOT product_found AND missing_product_expected GROUP BY mgrs_tile_id",
    "baseline_counts": "SELECT mgrs_tile_id, grp AS acq_group_id_within_mgrs_tile, pass_id, coalesce(n, 0) AS n_bursts_with_baseline FROM grps LEFT JOIN based USING (mgrs_tile_id, grp, pass_id)",
    "orphans": f"""
SELECT opera_id, mgrs_tile_id, {_T.format('acq_time')}, d AS nearest_pass_diff_seconds, 'output product exists but no matching RTC pass found in expected groups' AS reason
FROM (SELECT dedup.opera_id, dedup.mgrs_tile_id, acq_time, min(abs(epoch_us(acq_time) - epoch_us(post_acq_dt))) / 1e6 AS d FROM dedup LEFT JOIN grps USING (mgrs_tile_id) GROUP BY ALL) WHERE d IS NULL OR d > 3600
""",
    "expected_products": f"SELECT product_id, mgrs_tile_id, input_category, opera_id, opera_id_trunc, jpl_burst_id, polarizations, track_number, {_T.format('acq_dt')} FROM expected",
    "expected_index": f"SELECT mgrs_tile_id, product_id, {_T.format('post_min_dt')}, array_to_string(track_numbers, ',') AS track_numbers FROM idx",
    "parse_inputs": f"SELECT product, input_id, input_category, place, opera_id_trunc, jpl_burst_id, track_number, {_T.format('acq_dt')} FROM actual",
    "polarization_issues": """
, rows AS (SELECT 'P' || n AS product, CASE WHEN year(acq_dt) <= 1996 THEN 0 ELSE 1 END AS c, jpl_burst_id, did, polarizations AS pol, opera_id FROM granules WHERE year(acq_dt) <= 1997),
seen AS (SELECT *, last_value(pol) OVER (PARTITION BY product, jpl_burst_id ORDER BY c, opera_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lp, max(c) OVER (PARTITION BY product, jpl_burst_id) AS has FROM rows)
SELECT product, md5(coalesce(string_agg(did || '=' || pol, ';' ORDER BY c, opera_id) FILTER (pol NOT IN ('VV+VH', 'HH+HV')), '')) AS single_md5,
  md5(coalesce(string_agg(did || '=' || pol || ' vs post-image ' || lp, ';' ORDER BY c, opera_id) FILTER (c = 0 AND has = 1 AND pol <> lp), '')) AS mismatch_md5 FROM seen GROUP BY product
""",
    "polarization_issues_all": """
, rows AS (SELECT 'P' || n AS product, CASE WHEN year(acq_dt) <= 1996 THEN 0 ELSE 1 END AS c, jpl_burst_id, did, polarizations AS pol, opera_id FROM granules),
seen AS (SELECT *, last_value(pol) OVER (PARTITION BY product, jpl_burst_id ORDER BY c, opera_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lp, max(c) OVER (PARTITION BY product, jpl_burst_id) AS has FROM rows)
SELECT product, md5(coalesce(string_agg(did || '=' || pol, ';' ORDER BY c, opera_id) FILTER (pol NOT IN ('VV+VH', 'HH+HV')), '')) AS single_md5,
  md5(coalesce(string_agg(did || '=' || pol || ' vs post-image ' || lp, ';' ORDER BY c, opera_id) FILTER (c = 0 AND has = 1 AND pol <> lp), '')) AS mismatch_md5 FROM seen GROUP BY product
""",
    "product_match": "SELECT product, product_id FROM summ LEFT JOIN matches USING (product)",
    "inputs_audit": "SELECT * FROM audit",
    "issue_summary": "SELECT issue_type, count(*) AS n_rows FROM audit WHERE inputs_correct IS DISTINCT FROM TRUE GROUP BY issue_type",
    "inputs_pre": "SELECT * FROM audit WHERE inputs_correct IS DISTINCT FROM TRUE AND lower(issue_type) LIKE '%pre%' AND lower(issue_type) NOT LIKE '%post%'",
    "inputs_post": "SELECT * FROM audit WHERE inputs_correct IS DISTINCT FROM TRUE AND lower(issue_type) LIKE '%post%'",
    "lookback_ranges": """
SELECT CAST(row_number() OVER (ORDER BY o, a) - 1 AS INTEGER) AS n, strftime(a, '%Y-%m-%d %H:%M:%S') AS start, strftime(b, '%Y-%m-%d %H:%M:%S') AS stop
FROM (SELECT 0 AS o, TIMESTAMP '1999-01-01' - to_days(days + 60) AS a, TIMESTAMP '2001-01-01' - to_days(days) AS b FROM win UNION ALL SELECT 1, TIMESTAMP '1999-01-01', TIMESTAMP '2001-01-01')
""",
    "date_chunks": "SELECT CAST(i AS INTEGER) AS n, strftime(TIMESTAMP '1999-01-01' + to_days(CAST(7 * i AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS start, strftime(least(TIMESTAMP '1999-01-01' + to_days(CAST(7 * i + 7 AS INTEGER)), TIMESTAMP '2001-01-01'), '%Y-%m-%d %H:%M:%S') AS stop FROM range(0, 105) t(i)",
    "aoi_products": "SELECT opera_id, mgrs_tile_id FROM products WHERE -180 + n % 360 <= -120.5 AND -179 + n % 360 >= -150 AND -60 + (n // 360) % 120 <= -30 AND -59 + (n // 360) % 120 >= -60 AND acq_time >= TIMESTAMP '1995-01-01' AND acq_time < TIMESTAMP '1999-01-01'",
    "target_tiles": """
, t AS (SELECT DISTINCT lpad(CAST(c_custkey // 4 AS VARCHAR), 5, '0') AS mgrs_tile_id, c_custkey // 4 AS n FROM customer),
hit AS (SELECT mgrs_tile_id FROM t WHERE -180 + n % 360 <= -120.5 AND -179 + n % 360 >= -150 AND -60 + (n // 360) % 120 <= -30 AND -59 + (n // 360) % 120 >= -60),
b AS (SELECT DISTINCT jpl_burst_id, n FROM granules WHERE jpl_burst_id IN (SELECT jpl_burst_id FROM lut SEMI JOIN hit USING (mgrs_tile_id)))
SELECT mgrs_tile_id, greatest(min(-180 + n % 360) - 0.25, -180)::DOUBLE AS lon_min, greatest(min(-60 + (n // 360) % 120) - 0.25, -90)::DOUBLE AS lat_min, least(max(-179 + n % 360) + 0.25, 180)::DOUBLE AS lon_max, least(max(-59 + (n // 360) % 120) + 0.25, 90)::DOUBLE AS lat_max
FROM hit CROSS JOIN b GROUP BY mgrs_tile_id
""",
    "sample_tiles": "SELECT opera_id, mgrs_tile_id FROM products WHERE mgrs_tile_id IN (SELECT mgrs_tile_id FROM (SELECT DISTINCT mgrs_tile_id FROM products) ORDER BY md5('42|' || mgrs_tile_id), mgrs_tile_id LIMIT 5)",
    "resume_todo": "SELECT opera_id, mgrs_tile_id FROM tags WHERE error <> '' OR CAST(substr(string_split(opera_id, '_')[-1], 2) AS BIGINT) % 3 <> 0",
    "rtc_inputs_urls": """
, up AS (SELECT did AS opera_id_trunc, arg_max(polarizations, (acq_dt, opera_id)) AS pol FROM granules GROUP BY ALL)
SELECT product AS product_opera_id, input_id AS opera_id, input_category, strftime(acq_dt, '%Y-%m-%d %H:%M:%S') AS acq_time, jpl_burst_id,
  'https://data.example.org/inputs/' || input_id || '/' || input_id || CASE WHEN pol = 'HH+HV' THEN '_HH' ELSE '_VV' END || '.tif' AS url_copol,
  'https://data.example.org/inputs/' || input_id || '/' || input_id || CASE WHEN pol = 'HH+HV' THEN '_HV' ELSE '_VH' END || '.tif' AS url_crosspol FROM actual LEFT JOIN up USING (opera_id_trunc)
""",
    "tile_features": f"""
SELECT mgrs_tile_id, count(*) AS n_failures, string_agg(opera_id, ',' ORDER BY acq_time, opera_id) FILTER (nth <= 3) AS shown
FROM (SELECT *, row_number() OVER (PARTITION BY mgrs_tile_id ORDER BY acq_time, opera_id) AS nth FROM ({_DUP})) GROUP BY mgrs_tile_id
""",
}

_SQUARE = "'POLYGON ((' || x || ' ' || y || ', ' || (x + 1) || ' ' || y || ', ' || (x + 1) || ' ' || (y + 1) || ', ' || x || ' ' || (y + 1) || ', ' || x || ' ' || y || '))'"
_AT = "-180 + n % 360 AS x, -60 + (n // 360) % 120 AS y"
_SHAPES = f", shapes AS (SELECT lpad(CAST(n AS VARCHAR), 5, '0') AS mgrs_tile_id, {_SQUARE} AS geometry FROM (SELECT n, {_AT} FROM (SELECT DISTINCT c_custkey // 4 AS n FROM customer) WHERE n % 7 <> 0))"
_SOME = "(SELECT mgrs_tile_id FROM (SELECT DISTINCT mgrs_tile_id FROM products) ORDER BY md5('42|' || mgrs_tile_id), mgrs_tile_id LIMIT 5)"
_FOUR = "rtrim(rtrim(printf('%.4f', {0}), '0'), '.')"
_COUNTED = """
SELECT '{0}' AS key, ({1}) AS n_checked, count(*) AS n_failures, count(*) > 50000 AS truncated, least(count(*), 50000) AS n_shown,
  count(DISTINCT mgrs_tile_id) FILTER (nth <= 50000 AND mgrs_tile_id IN (SELECT mgrs_tile_id FROM shapes)) AS n_tiles
FROM (SELECT *, row_number() OVER (ORDER BY opera_id) AS nth FROM ({2}))
"""

_SELECTS |= {
    "ids_of_urls": "SELECT opera_id, string_split(alert_url, '/')[-2] AS url_id FROM purl",
    "input_counts": "SELECT product, mgrs_tile_id, input_category, count(*) AS n_inputs FROM actual GROUP BY ALL",
    "tile_totals": "SELECT count(*) AS n_products, count(DISTINCT mgrs_tile_id) AS n_tiles FROM products",
    "left_out": "SELECT polarizations, count(*) AS n_inputs FROM granules WHERE polarizations NOT IN ('VV+VH', 'HH+HV') GROUP BY ALL",
    "product_geometry": _SHAPES + " SELECT opera_id, mgrs_tile_id, geometry FROM products LEFT JOIN shapes USING (mgrs_tile_id)",
    "input_geometry": f"SELECT opera_id, jpl_burst_id, CASE WHEN n % 7 <> 0 THEN {_SQUARE} END AS geometry FROM (SELECT *, {_AT} FROM granules)",
    "tile_outlines": """
SELECT lpad(CAST(n AS VARCHAR), 5, '0') AS mgrs_tile_id, 'POLYGON ((' || {0} || ' ' || {2} || ', ' || {1} || ' ' || {2} || ', ' || {0} || ' ' || {3} || ', ' || {0} || ' ' || {2} || '))' AS outline
FROM (SELECT n, n % 360 - 180 + (n % 977) / 977 AS x, n % 170 - 85 - (n % 983) / 983 AS y FROM (SELECT DISTINCT c_custkey // 4 AS n FROM customer))
""".format(*[_FOUR.format(v) for v in ("x", "x + 0.5", "y", "y + 0.25")]),
    "frame_of_tiles": f"SELECT opera_id, mgrs_tile_id, pass_id, grp AS acq_group_id_within_mgrs_tile, track_token FROM frame WHERE mgrs_tile_id IN {_SOME}",
    "expected_of_tiles": f"SELECT * FROM ({_SELECTS['expected_products']}) WHERE mgrs_tile_id IN {_SOME}",
    "tags_todo": "SELECT opera_id, alert_url FROM purl WHERE alert_url IS NOT NULL AND k % 6 <> 0",
    "product_items": f"""
SELECT opera_id, mgrs_tile_id, {_T.format('acq_time')}, {_T.format('processing_time')}, sat, opera_dedup_id, CASE WHEN k % 41 <> 0 THEN f || '_GEN-DIST-STATUS.tif' END AS alert_url,
  CASE WHEN k % 3 <> 0 THEN f || '_GEN-METRIC.tif' END AS metric_url, CASE WHEN k % 2 = 0 THEN f || '_GEN-DIST-STATUS-ACQ.tif' END AS alert_acq_url
FROM (SELECT *, 'https://data.example.org/products/' || opera_id || '/' || opera_id AS f FROM products)
""",
    "input_items": f"""
SELECT opera_id, jpl_burst_id, {_T.format('acq_dt')}, {_T.format('processing_dt')}, track_number, CASE WHEN n % 50 = 0 THEN '' ELSE polarizations END AS polarizations,
  f || string_split(polarizations, '+')[1] || '.tif' AS url_copol, coalesce(f || nullif(string_split(polarizations, '+')[2], '') || '.tif', '') AS url_crosspol
FROM (SELECT *, 'https://data.example.org/inputs/' || opera_id || '/' || opera_id || '_' AS f FROM raw)
""",
    "search_links": f"""
SELECT opera_id, CASE WHEN k % 7 <> 0 AND k % 9 = 0 THEN '' ELSE 'https://search.example.org/?polygon=' || url_encode(replace(replace({_SQUARE}, ', ', ','), 'POLYGON (', 'POLYGON(')) ||
  '&start=' || strftime(acq_time - to_days(1), '%Y-%m-%dT%H:%M:%SZ') || '&end=' || strftime(acq_time + to_days(1), '%Y-%m-%dT%H:%M:%SZ') || '&resultsLoaded=true' END AS search_url FROM (SELECT *, {_AT} FROM products)
""",
    "section_duplicates": _SHAPES + _COUNTED.format("duplicates", "SELECT count(*) FROM products", _DUP),
    "section_ordering": _SHAPES + _COUNTED.format("ordering", f"SELECT count(*) FROM ({_SELECTS['processing_order']}) WHERE evaluated", f"SELECT * FROM ({_SELECTS['processing_order']}) WHERE out_of_order"),
}


def oracle_sql() -> dict[str, str]:
    return {name: f"WITH {_TABLES.strip()}\n{select.strip()}" for name, select in _SELECTS.items()}
