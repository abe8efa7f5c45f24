"""Recorded inputs of products against the expected ones: one row an issue.

The issue texts are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passledger.functions import ids, times
from passledger.operators.temporal import around
from passledger.schemas import DUAL_POLARIZATIONS, MATCH_BUFFER_SECONDS, N_TRACKS

SINGLE, MISMATCH = "Single polarization input used", "Pre RTC baseline polarization mismatch"
TRACKS, SPAN, BURSTS = "Too many track numbers present", "Post-dates span too long", "Burst ID mismatch"
PRE_LOST, PRE_MORE = "Pre RTC IDs expected but not found", "Pre RTC IDs found but not expected"
POST_LOST, POST_MORE = "Post RTC IDs expected but not found", "Post RTC IDs found but not expected"
NO_PRODUCT, ENUMERATION, UNREAD = "No expected product found", "Enumeration error", "Tag read error"
RESULT = ["opera_id", "mgrs_tile_id", "inputs_correct", "issue_type", "issue_value"]


def parse_actual_inputs(tags: DataFrame) -> DataFrame:
    """A row for each recorded input: product, category, place in its list, and what its id says."""

    def listed_in(column: str, category: str) -> Column:
        return F.transform(ids.not_empty_parts(column), lambda x, i: F.struct(x.alias("input_id"), F.lit(category).alias("input_category"), i.alias("place")))

    listed = F.concat(listed_in("pre_rtc_opera_ids", "pre"), listed_in("post_rtc_opera_ids", "post"))
    df = tags.select(F.col("opera_id").alias("product"), "mgrs_tile_id", F.explode(listed).alias("x")).select("product", "mgrs_tile_id", "x.*")
    df = df.withColumn("opera_id_trunc", ids.truncated("input_id")).withColumn("jpl_burst_id", ids.burst_id("input_id"))
    return df.withColumn("track_number", ids.track_number("jpl_burst_id")).withColumn("acq_dt", ids.acquisition_time("input_id"))


def input_counts(actual: DataFrame) -> DataFrame:
    """Recorded inputs of each product and category."""
    return actual.groupBy("product", "mgrs_tile_id", "input_category").agg(F.count("*").alias("n_inputs"))


def tracks_adjacent(tracks: Column) -> Column:
    """One track at most, or two neighbours; the last is next to the first."""
    apart = F.abs(F.get(tracks, F.lit(0)) - F.get(tracks, F.lit(1)))
    return (F.size(tracks) <= 1) | ((F.size(tracks) == 2) & apart.isin(1, N_TRACKS - 1))


def polarization_map(inputs: DataFrame, keys: list[str]) -> DataFrame:
    """Polarizations of each truncated id; of several granules the latest counts.

    With a track it reads the columns that the enumeration reads, so that Spark deals out inputs once for both.
    """
    df = inputs.withColumn("opera_id_trunc", ids.truncated("opera_id"))
    latest = F.struct("acq_dt", "opera_id", *[c for c in ("track_number",) if c in inputs.columns])
    return df.groupBy(*keys, "opera_id_trunc").agg(F.max_by("polarizations", latest).alias("polarizations")).where(F.col("polarizations").isNotNull())


def polarization_issues(actual: DataFrame, pols: DataFrame, keys: list[str]) -> DataFrame:
    """Single-polarized inputs, and pre inputs polarized unlike the post input of their burst.

    Inputs without known polarizations are passed over; of a burst's post inputs the last
    in the list counts.
    """
    return _with_post_polarization(actual.join(pols, [*keys, "opera_id_trunc"])).groupBy("product").agg(*_polarization_texts())


def _with_post_polarization(known: DataFrame) -> DataFrame:
    """Dealt out by product; `post_pol`: of the last post input with known polarizations of a product's burst."""
    post = F.when(F.col("input_category") == "post", F.col("polarizations"))
    place = F.when((F.col("input_category") == "post") & F.col("polarizations").isNotNull(), F.col("place"))
    return known.repartition("product").withColumn("post_pol", F.max_by(post, place).over(Window.partitionBy("product", "jpl_burst_id")))


def _polarization_texts() -> list[Column]:
    order = F.struct(F.when(F.col("input_category") == "pre", 0).otherwise(1).alias("c"), F.col("place").alias("p"))
    text = lambda rows: F.array_join(F.transform(F.sort_array(F.collect_list(rows)), lambda x: x["text"]), ";")
    single = F.when(~F.col("polarizations").isin(*DUAL_POLARIZATIONS), F.struct(order.alias("o"), F.concat("opera_id_trunc", F.lit("="), "polarizations").alias("text")))
    unlike = (F.col("input_category") == "pre") & F.col("jpl_burst_id").isNotNull() & (F.col("polarizations") != F.col("post_pol"))
    differs = F.when(unlike, F.struct(order.alias("o"), F.concat("opera_id_trunc", F.lit("="), "polarizations", F.lit(" vs post-image "), "post_pol").alias("text")))
    return [text(single).alias("single_text"), text(differs).alias("mismatch_text")]


def _set(category: str, name: str) -> Column:
    return F.collect_set(F.when(F.col("input_category") == category, F.col("opera_id_trunc"))).alias(name)


def _summaries() -> list[Column]:
    """Sets, tracks and post times of recorded inputs."""
    post = F.when(F.col("input_category") == "post", F.col("acq_dt"))
    broken = F.col("jpl_burst_id").isNull() | F.col("track_number").isNull() | F.col("acq_dt").isNull()
    return [
        _set("pre", "pre_ids"), _set("post", "post_ids"), F.sort_array(F.collect_set("jpl_burst_id")).alias("bursts"), F.sort_array(F.collect_set("track_number")).alias("tracks"),
        F.min(post).alias("post_min"), F.max(post).alias("post_max"), F.max(F.when(broken, F.col("input_id"))).alias("broken_id"),
    ]


def actual_summary(actual: DataFrame, keys: tuple[str, ...] = ("product",)) -> DataFrame:
    """Sets, tracks and post times of each product's recorded inputs."""
    return actual.groupBy(*keys).agg(*_summaries())


def _audited(actual: DataFrame, pols: DataFrame, keys: list[str]) -> DataFrame:
    """Summary and polarization issues of each product's recorded inputs, dealt out by product once."""
    return _with_post_polarization(actual.join(pols, [*keys, "opera_id_trunc"], "left")).groupBy("product").agg(*_summaries(), *_polarization_texts())


def match_expected(products: DataFrame, index: DataFrame, buffer: int = MATCH_BUFFER_SECONDS) -> DataFrame:
    """`products` (product, mgrs_tile_id, tracks, post_min) with the `product_id`, and what else `index`
    holds, of the only expected product of the tile that starts less than `buffer` seconds apart and
    shares a track; else null."""
    width = buffer * 1_000_000
    left = products.select("product", "mgrs_tile_id", "tracks", "post_min").withColumn("_bin", F.explode(around(F.col("post_min"), width)))
    right = index.withColumn("_bin", times.bins(F.col("post_min_dt"), width))
    close = times.seconds_between(F.col("post_min"), F.col("post_min_dt")) < buffer
    found = left.join(right, ["mgrs_tile_id", "_bin"]).where(close & F.arrays_overlap("tracks", "track_numbers"))
    held = ["product_id", *[c for c in index.columns if c not in ("mgrs_tile_id", "product_id", "post_min_dt", "track_numbers")]]
    only = found.select("product", F.struct(*held).alias("_x")).withColumn("_n", F.count("*").over(Window.partitionBy("product"))).where("_n = 1")
    return products.join(only.select("product", "_x.*"), "product", "left")


def _issue(when: Column, kind: str, value: Column) -> Column:
    return F.when(when, F.struct(F.lit(kind).alias("issue_type"), value.alias("issue_value")))


def _differences() -> Column:
    """Issues of a product with an expected one, in a fixed order."""
    sets = [(PRE_LOST, "exp_pre", "pre_ids"), (PRE_MORE, "pre_ids", "exp_pre"), (POST_LOST, "exp_post", "post_ids"), (POST_MORE, "post_ids", "exp_post")]
    span = times.micros(F.col("post_max")) - times.micros(F.col("post_min"))
    issues = F.array(
        _issue(F.col("single_text") != "", SINGLE, F.col("single_text")),
        _issue(F.col("mismatch_text") != "", MISMATCH, F.col("mismatch_text")),
        _issue(~tracks_adjacent(F.col("tracks")), TRACKS, times.int_list(F.col("tracks"))),
        _issue(F.floor(span / times.DAY) > 1, SPAN, times.span_text(span)),
        _issue(F.col("exp_bursts") != F.col("bursts"), BURSTS, F.concat(F.lit("expected="), times.str_list(F.col("exp_bursts")), F.lit("; found="), times.str_list(F.col("bursts")))),
        *[_issue(F.size(F.array_except(a, b)) > 0, kind, F.array_join(F.sort_array(F.array_except(a, b)), ";")) for kind, a, b in sets],
    )
    return F.filter(issues, lambda x: x.isNotNull())


def _exploded(df: DataFrame, issues: Column, unread: Column) -> DataFrame:
    """A row an issue, or one without issue; `unread`: it is not known whether inputs are correct."""
    none = F.array(F.struct(F.lit("").alias("issue_type"), F.lit("").alias("issue_value")))
    df = df.withColumn("_issues", issues)
    df = df.withColumn("inputs_correct", F.when(~unread, F.size("_issues") == 0)).withColumn("_x", F.explode(F.when(F.size("_issues") > 0, F.col("_issues")).otherwise(none)))
    return df.select(F.col("product").alias("opera_id"), "mgrs_tile_id", "inputs_correct", "_x.issue_type", "_x.issue_value")


def _expected_sets() -> list[Column]:
    return [_set("pre", "exp_pre"), _set("post", "exp_post"), F.sort_array(F.collect_set("jpl_burst_id")).alias("exp_bursts")]


def expected_sets(expected: DataFrame, key: str = "product_id") -> DataFrame:
    return expected.groupBy(key).agg(*_expected_sets())


def expected_summary(expected: DataFrame) -> DataFrame:
    """First post time, tracks and sets of each expected product, in one pass over its inputs."""
    post = F.col("input_category") == "post"
    own = expected.where(F.col("mgrs_tile_id").isNotNull()).groupBy("mgrs_tile_id", "product_id")
    tracks = F.sort_array(F.collect_set(F.when(post, F.col("track_number")))).alias("track_numbers")
    return own.agg(F.min(F.when(post, F.col("acq_dt"))).alias("post_min_dt"), tracks, *_expected_sets())


_EMPTY = {"pre_ids": "array<string>", "post_ids": "array<string>", "bursts": "array<string>", "tracks": "array<int>", "exp_pre": "array<string>", "exp_post": "array<string>", "exp_bursts": "array<string>"}


def _completed(df: DataFrame) -> DataFrame:
    """Empty sets and texts where a product has no inputs, expectations or known polarizations."""
    return df.fillna("", ["single_text", "mismatch_text"]).withColumns({c: F.coalesce(c, F.array().cast(t)) for c, t in _EMPTY.items()})


def _one(kind: str, value: Column) -> Column:
    return F.array(F.struct(F.lit(kind).alias("issue_type"), value.cast("string").alias("issue_value")))


def check_inputs(tags: DataFrame, frame: DataFrame, expected: DataFrame, unfiltered: DataFrame | None = None, input_label: str = "RTC") -> DataFrame:
    """Audits the recorded inputs of all products in `tags`.

    Products with a read error, in a tile that the frame lacks, with an input whose id
    cannot be read, or without exactly one expected product get one row that says so.
    Polarizations come from `frame`, which has dual-polarized inputs only, or from
    `unfiltered` inputs if given; then single-polarized inputs are named as such.
    Products without a tile are left out, unless their tags could not be read.
    """
    read = F.coalesce(F.col("error") == "", F.lit(False))
    own = tags.withColumn("_read", read).where(~F.col("_read") | F.col("mgrs_tile_id").isNotNull())
    keys, pols = (["mgrs_tile_id"], polarization_map(frame, ["mgrs_tile_id"])) if unfiltered is None else ([], polarization_map(unfiltered, []))
    audited = _audited(parse_actual_inputs(own.where("_read")), pols, keys)
    known = frame.where(F.col("mgrs_tile_id").isNotNull()).select("mgrs_tile_id").distinct().withColumn("_known", F.lit(True))
    products = own.select(F.col("opera_id").alias("product"), "mgrs_tile_id", "error", "_read").join(known, "mgrs_tile_id", "left").join(audited, "product", "left")
    df = match_expected(products, expected_summary(expected))
    df = _completed(df)
    post = F.coalesce(times.utc_text(F.col("post_min")), F.lit("NaT"))
    absent, broken = F.col("_known").isNull(), F.col("broken_id").isNotNull()
    issues = (
        F.when(~F.col("_read"), _one(UNREAD, F.col("error")))
        .when(absent, _one(NO_PRODUCT, F.concat(F.lit("tile="), "mgrs_tile_id", F.lit(f" absent from {input_label} table"))))
        .when(broken, _one(ENUMERATION, F.concat(F.lit("ValueError: cannot parse input id "), "broken_id")))
        .when(F.col("product_id").isNull(), _one(NO_PRODUCT, F.concat(F.lit("tile="), "mgrs_tile_id", F.lit("; tracks="), times.int_list(F.col("tracks")), F.lit("; post="), post)))
        .otherwise(_differences())
    )
    return _exploded(df, issues, ~F.col("_read") | (~absent & broken))


def online_comparison(tags: DataFrame, expected_of: DataFrame) -> DataFrame:
    """Audits against inputs enumerated for each product by a service, instead of matching.

    `expected_of`: rows of `build_expected_products` with `product` in place of a tile's
    match, as a connector returns them, and `error` where it failed.
    """
    read = F.coalesce(F.col("error") == "", F.lit(False))
    own = tags.withColumn("_read", read)
    failed = expected_of.where(F.coalesce(F.col("error") != "", F.lit(False))).groupBy("product").agg(F.min("error").alias("_failed"))
    actual = parse_actual_inputs(own.where("_read"))
    expected = expected_of.where(F.coalesce(F.col("error"), F.lit("")) == "")
    pols = expected.groupBy("product", "opera_id_trunc").agg(F.max("polarizations").alias("polarizations")).where(F.col("polarizations").isNotNull())
    df = own.select(F.col("opera_id").alias("product"), "mgrs_tile_id", "error", "_read").join(_audited(actual, pols, ["product"]), "product", "left").join(failed, "product", "left")
    df = df.join(expected_sets(expected, "product"), "product", "left")
    unread, broken = ~F.col("_read"), F.col("_failed").isNotNull()
    issues = F.when(unread, _one(UNREAD, F.col("error"))).when(broken, _one(ENUMERATION, F.col("_failed"))).otherwise(_differences())
    return _exploded(_completed(df), issues, unread | broken)


def incorrect(results: DataFrame) -> DataFrame:
    """Rows that are not correct; unread ones are among them."""
    return results.where(~F.col("inputs_correct").eqNullSafe(True))


def post_issues(bad: DataFrame) -> DataFrame:
    return bad.where(F.contains(F.lower("issue_type"), F.lit("post")))


def pre_issues(bad: DataFrame) -> DataFrame:
    """Issues with "pre" but not "post" in their name; "present" counts."""
    kind = F.lower("issue_type")
    return bad.where(F.contains(kind, F.lit("pre")) & ~F.contains(kind, F.lit("post")))


def issue_summary(bad: DataFrame) -> DataFrame:
    return bad.groupBy("issue_type").agg(F.count("*").alias("n_rows"))


def settled(results: DataFrame) -> DataFrame:
    """Results without the errors of products that a later try could audit."""
    failed = F.coalesce(F.col("issue_type").isin(UNREAD, ENUMERATION), F.lit(False))
    audited = results.where(~failed).select("opera_id").distinct()
    return results.where(~failed).unionByName(results.where(failed).join(audited, "opera_id", "left_anti").select(*results.columns)).distinct()


def resume(tags: DataFrame, done: DataFrame, retry_errors: bool = False) -> DataFrame:
    """Tags of products that earlier results lack, or hold only errors if these are to be tried again."""
    kept = done.where(~F.col("issue_type").isin(UNREAD, ENUMERATION)) if retry_errors else done
    return tags.join(kept.select("opera_id").distinct(), "opera_id", "left_anti")
