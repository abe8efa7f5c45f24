from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from passledger import schemas
from passledger.operators import checks, dedup

T0 = datetime(2026, 1, 1)


def products(spark, *rows):
    """(tile, acquisition day, processing hours after)."""
    out = []
    for tile, day, hours in rows:
        acq = T0 + timedelta(days=day)
        done = None if hours is None else acq + timedelta(hours=hours)
        key = f"FX_L3_A_T{tile}_{acq:%Y%m%dT%H%M%SZ}"
        out.append((f"{key}_{'x' if done is None else f'{done:%Y%m%dT%H%M%SZ}'}_S1", tile, acq, done, key, None))
    return spark.createDataFrame(out, "opera_id string, mgrs_tile_id string, acq_time timestamp_ntz, processing_time timestamp_ntz, opera_dedup_id string, alert_url string")


def test_dedup_keeps_latest_and_is_idempotent(spark):
    p = products(spark, ("A", 0, 5), ("A", 0, 9), ("A", 1, 2))
    once = dedup.deduplicate_products(p)
    assert {(r.n_versions, r.processing_time) for r in once.collect()} == {(2, T0 + timedelta(hours=9)), (1, T0 + timedelta(days=1, hours=2))}
    again = dedup.deduplicate_products(once.drop("n_versions"))
    assert {r.opera_id for r in again.collect()} == {r.opera_id for r in once.collect()}


def test_missing_processing_time_counts_as_latest(spark):
    kept = dedup.deduplicate_products(products(spark, ("A", 0, 5), ("A", 0, None))).first()
    assert kept.processing_time is None and kept.n_versions == 2


def test_duplicates(spark):
    found = {r.is_latest: r for r in checks.check_duplicates(products(spark, ("A", 0, 5), ("A", 0, 9), ("A", 1, 2))).collect()}
    assert found[True].reprocessing_lag_hours == 4.0 and found[False].reprocessing_lag_hours == 0.0
    assert found[True].reason == "2 granules share acquisition FX_L3_A_TA_20260101T000000Z; latest, kept"
    assert found[False].reason.endswith(f"superseded by {found[True].opera_id}")


def test_order_compares_with_previous_and_skips_reprocessed(spark):
    p = dedup.deduplicate_products(products(spark, ("A", 0, 100), ("A", 1, 10), ("A", 2, 10), ("A", 3, 1), ("A", 3, 500), ("A", 4, 10)))
    rows = checks.check_processing_order(p).orderBy("acq_time").collect()
    assert [r.out_of_order for r in rows] == [False, True, False, False, False]
    assert [r.evaluated for r in rows] == [False, True, True, False, True]
    assert rows[1].reason == f"processed 66.0 h before the previous acquisition in the tile ({rows[0].opera_id})"
    assert rows[3].is_reprocessed and rows[3].prev_opera_id is None
    assert rows[4].prev_opera_id == rows[2].opera_id
    assert all(r.evaluated for r in rows if r.out_of_order)


def test_order_does_not_hang_on_row_order(spark):
    p = products(spark, *[("A", d, (d * 37) % 50) for d in range(12)])
    a = checks.check_processing_order(dedup.deduplicate_products(p))
    b = checks.check_processing_order(dedup.deduplicate_products(p.orderBy(F.desc("acq_time")).repartition(3)))
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def chain(spark, priors, **options):
    p = dedup.deduplicate_products(products(spark, *[("A", d, 5) for d in range(len(priors))])).orderBy("acq_time")
    names = [r.opera_id for r in p.collect()]
    tags = spark.createDataFrame([(n, "" if prior != "ERR" else "OSError: x", "A", "", "", None if prior is None else prior.format(*names)) for n, prior in zip(names, priors) if prior != "NONE"], schemas.TAGS)
    return names, checks.check_confirmation(p, tags, **options).orderBy("acq_time").collect()


def test_confirmation(spark):
    names, rows = chain(spark, ["", "x/{0}", "{0}", "ERR", "NONE", None])
    assert [r.confirmed_ok for r in rows] == [True, True, False, False, False, False]
    assert rows[2].reason == f"prior product used: {names[0]}; expected: {names[1]}"
    assert [r.tag_missing for r in rows] == [False, False, False, True, True, True]
    assert rows[3].reason == "could not read prior product tag" and all(r.tile_incomplete for r in rows)


def test_confirmation_at_start(spark):
    assert chain(spark, ["somewhere/P"])[1][0].confirmed_ok
    assert not chain(spark, ["somewhere/P"], expect_none_at_start=True)[1][0].confirmed_ok
    assert chain(spark, [""], expect_none_at_start=True)[1][0].confirmed_ok


def test_reprocessed_predecessor_is_no_difference(spark):
    names, rows = chain(spark, ["", "FX_L3_A_TA_20260101T000000Z_20290101T000000Z_S1"])
    assert rows[1].confirmed_ok


def test_tile_summary(spark):
    df = products(spark, ("A", 0, 1), ("A", 1, 1), ("B", 0, 1)).withColumn("fail", F.col("mgrs_tile_id") == "A")
    got = {r.mgrs_tile_id: r for r in checks.summarize_by_tile(df, "fail").collect()}
    assert got["B"].ok and got["B"].bad_opera_ids == ""
    assert got["A"].n_failures == 2 and got["A"].bad_opera_ids.split(";") == sorted(got["A"].bad_opera_ids.split(";"))


@pytest.mark.parametrize("check", [checks.check_duplicates, lambda p: checks.check_processing_order(dedup.deduplicate_products(p))])
def test_empty_tables_keep_their_columns(spark, check):
    out = check(products(spark).limit(0))
    assert out.count() == 0 and "reason" in out.columns
