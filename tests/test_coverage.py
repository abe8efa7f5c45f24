from datetime import datetime, timedelta

from pyspark.sql import functions as F

from passledger.operators import coverage, temporal
from passledger.operators.frame import build_input_frame

T0 = datetime(2026, 1, 10)
DAY = timedelta(days=1)


def frame(spark, *rows):
    """(burst, acquisition, polarizations)."""
    made = [(f"FX_L2_I_{b}_{t:%Y%m%dT%H%M%SZ}_{p}", b, t, 1, p, "g") for b, t, p in rows]
    df = spark.createDataFrame(made, "opera_id string, jpl_burst_id string, acq_dt timestamp, track_number int, polarizations string, geometry string")
    return build_input_frame(df, df.select("jpl_burst_id", F.lit("A").alias("mgrs_tile_id")))


def products(spark, *times):
    return spark.createDataFrame([(f"P{i}", "A", t) for i, t in enumerate(times)], "opera_id string, mgrs_tile_id string, acq_time timestamp_ntz")


def groups(f):
    return coverage.expected_pass_groups(f, "2026-01-01", "2026-02-01")


def test_groups_leave_out_single_polarization_and_other_times(spark):
    f = frame(spark, ("b1", T0, "VV+VH"), ("b2", T0 + timedelta(seconds=3), "HH+HV"), ("b3", T0, "VV"), ("b1", datetime(2025, 12, 1), "VV+VH"), ("b1", datetime(2026, 2, 1), "VV+VH"))
    (g,) = groups(f).collect()
    assert (g.n_bursts, g.burst_ids, g.burst_pols, g.post_acq_dt) == (2, ["b1", "b2"], ["b1|VV+VH", "b2|HH+HV"], T0)


def test_match_is_inclusive_and_takes_the_earlier_of_equals(spark):
    f = frame(spark, ("b1", T0, "VV+VH"))
    match = lambda *t: coverage.check_coverage(groups(f), products(spark, *t)).first()
    hour = timedelta(hours=1)
    assert match(T0 + hour).product_found and match(T0 + hour).time_diff_seconds == 3600.0
    assert not match(T0 + hour + timedelta(seconds=1)).product_found
    assert match(T0 + timedelta(minutes=5), T0 - timedelta(minutes=5)).matched_opera_id == "P1"
    gone = match(T0 + 2 * hour)
    assert gone.missing_product_expected and gone.reason == "no output product for RTC pass at 2026-01-10 00:00:00+00:00 (baseline not checked (no lookback RTC metadata))"


def test_baseline_windows_are_half_open(spark):
    def n(*acquisitions):
        f = frame(spark, ("b1", T0, "VV+VH"), *acquisitions)
        return coverage.check_coverage(groups(f), products(spark), f).first().n_bursts_with_baseline

    assert n() == 0
    assert n(("b1", T0 - 365 * DAY, "VV+VH")) == 0
    assert n(("b1", T0 - 425 * DAY, "VV+VH")) == 1
    assert n(("b1", T0 - 425 * DAY - timedelta(seconds=1), "VV+VH")) == 0
    assert n(("b1", T0 - 366 * DAY, "HH+HV")) == 0
    assert n(("b2", T0 - 366 * DAY, "VV+VH")) == 0
    assert n(("b1", T0 - 1100 * DAY, "VV+VH"), ("b1", T0 - 400 * DAY, "VV+VH")) == 1


def test_windows_against_brute_force(spark):
    posts = spark.createDataFrame([(i, "k", T0 + timedelta(days=i, hours=7 * i)) for i in range(20)], "n int, key string, post timestamp")
    acqs = spark.createDataFrame([("k", T0 - timedelta(days=d, hours=(d * 5) % 24)) for d in range(330, 1200, 3)], "key string, acq timestamp")
    both = posts.withColumn("t", F.unix_micros("post")).unionByName(acqs.withColumn("t", F.unix_micros("acq")), allowMissingColumns=True)
    rows = both.select("*", *[F.collect_list("acq").over(w).alias(f"w{i}") for i, w in enumerate(temporal.lookback(["key"], "t"))]).where("n is not null").collect()
    got = {(r.n, acq, i) for r in rows for i in range(3) for acq in r[f"w{i}"]}
    want = {(p.n, a.acq, w) for p in posts.collect() for a in acqs.collect() for w, d in enumerate((365, 730, 1095)) if p.post - (d + 60) * DAY <= a.acq < p.post - d * DAY}
    assert got == want and want


def test_orphans(spark):
    f = frame(spark, ("b1", T0, "VV+VH"))
    p = products(spark, T0 + timedelta(hours=1), T0 + timedelta(hours=1, seconds=1), T0 - 40 * DAY).unionByName(spark.createDataFrame([("Q", "Z", T0)], "opera_id string, mgrs_tile_id string, acq_time timestamp_ntz"))
    got = {r.opera_id: r.nearest_pass_diff_seconds for r in coverage.check_orphans(groups(f), p).collect()}
    assert got == {"P1": 3601.0, "P2": 40 * 86400.0, "Q": None}


def test_found_and_missing_make_all_passes(spark, sf_dir):
    from passledger import fixtures as fx
    from passledger.operators.dedup import deduplicate_products

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    g = coverage.expected_pass_groups(fx.frame(spark, sf_dir), fx.START, fx.STOP)
    cov = coverage.check_coverage(g, deduplicate_products(fx.products(spark, sf_dir)))
    found, missing = cov.agg(F.count_if("product_found"), F.count_if("missing_product_expected")).first()
    assert found + missing == g.count() and found and missing
