"""One planted defect at a time: exactly its issue comes out."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from passledger import schemas
from passledger.operators import inputs_audit as ia

POST = datetime(2026, 1, 10)


def rtc(burst, t):
    return f"FX_L2_I_{burst}_{t:%Y%m%dT%H%M%SZ}_20270101T000000Z_S1A"


B1, B2 = "T012-000001-IW1", "T012-000002-IW2"
PRE1, PRE2 = rtc(B1, POST - timedelta(days=370)), rtc(B2, POST - timedelta(days=371))
NOW1, NOW2 = rtc(B1, POST), rtc(B2, POST + timedelta(seconds=3))


def expected(spark, extra=()):
    rows = [("E1", "A", c, i, "_".join(i.split("_")[:5]), i.split("_")[3], "VV+VH", 12, datetime.strptime(i.split("_")[4], "%Y%m%dT%H%M%SZ")) for c, i in (("pre", PRE1), ("pre", PRE2), ("post", NOW1), ("post", NOW2))]
    return spark.createDataFrame([*rows, *extra], "product_id string, mgrs_tile_id string, input_category string, opera_id string, opera_id_trunc string, jpl_burst_id string, polarizations string, track_number int, acq_dt timestamp")


def frame(spark, pols=None):
    ids = {PRE1: "VV+VH", PRE2: "VV+VH", NOW1: "VV+VH", NOW2: "VV+VH"} | (pols or {})
    return spark.createDataFrame([(i, "A", p, datetime.strptime(i.split("_")[4], "%Y%m%dT%H%M%SZ")) for i, p in ids.items()], "opera_id string, mgrs_tile_id string, polarizations string, acq_dt timestamp")


def audit(spark, pre=(PRE1, PRE2), post=(NOW1, NOW2), error="", tile="A", pols=None, extra=()):
    tags = spark.createDataFrame([("P", error, tile, ",".join(pre), ",".join(post), "")], schemas.TAGS)
    return [(r.inputs_correct, r.issue_type, r.issue_value) for r in ia.check_inputs(tags, frame(spark, pols), expected(spark, extra)).collect()]


def short(i):
    return "_".join(i.split("_")[:5])


def test_clean(spark):
    assert audit(spark) == [(True, "", "")]


def test_reprocessed_input_is_no_difference(spark):
    assert audit(spark, pre=(PRE1.replace("20270101", "20280101"), PRE2)) == [(True, "", "")]


FAR = rtc("T099-000009-IW1", POST - timedelta(days=370))
LATE = rtc(B1, POST + timedelta(days=3))


@pytest.mark.parametrize(
    ("change", "want"),
    [
        ({"pre": (PRE1,)}, {"Burst ID mismatch": None, ia.PRE_LOST: short(PRE2)}),
        ({"post": (NOW1,)}, {ia.POST_LOST: short(NOW2)}),
        ({"post": (NOW1, NOW2, LATE)}, {ia.SPAN: "3 days 00:00:00", ia.POST_MORE: short(LATE)}),
        ({"pre": (PRE1, PRE2, FAR)}, {ia.TRACKS: "[12, 99]", ia.BURSTS: f"expected=['{B1}', '{B2}']; found=['{B1}', '{B2}', 'T099-000009-IW1']", ia.PRE_MORE: short(FAR)}),
        ({"pols": {PRE1: "HH+HV"}}, {ia.MISMATCH: f"{short(PRE1)}=HH+HV vs post-image VV+VH"}),
        ({"pols": {NOW2: "VV"}}, {ia.SINGLE: f"{short(NOW2)}=VV", ia.MISMATCH: f"{short(PRE2)}=VV+VH vs post-image VV"}),
    ],
)
def test_planted(spark, change, want):
    got = audit(spark, **change)
    if change.get("pre") == (PRE1,):  # the burst stays, through its post input
        want = {ia.PRE_LOST: short(PRE2)}
    assert {k: v for _, k, v in got} == want and all(ok is False for ok, _, _ in got)


def test_unread_absent_broken_unmatched(spark):
    assert audit(spark, error="OSError: x") == [(None, ia.UNREAD, "OSError: x")]
    assert audit(spark, tile="Z") == [(False, ia.NO_PRODUCT, "tile=Z absent from RTC table")]
    assert audit(spark, post=(NOW1, "bad_id")) == [(None, ia.ENUMERATION, "ValueError: cannot parse input id bad_id")]
    assert audit(spark, pre=(), post=()) == [(False, ia.NO_PRODUCT, "tile=A; tracks=[]; post=NaT")]


@pytest.mark.parametrize(("seconds", "found"), [(0, True), (299, True), (300, False), (-299, True), (-300, False)])
def test_match_buffer_is_strict(spark, seconds, found):
    moved = [rtc(B1, POST + timedelta(seconds=seconds)), rtc(B2, POST + timedelta(seconds=seconds + 3))]
    kinds = {k for _, k, _ in audit(spark, post=tuple(moved))}
    assert (ia.NO_PRODUCT not in kinds) is found


def test_two_candidates_are_none(spark):
    other = ("E2", "A", "post", NOW1, short(NOW1), B1, "VV+VH", 12, POST)
    assert audit(spark, extra=(other,)) == [(False, ia.NO_PRODUCT, "tile=A; tracks=[12]; post=2026-01-10 00:00:00+00:00")]


@pytest.mark.parametrize(("tracks", "ok"), [([], True), ([5], True), ([5, 6], True), ([1, 175], True), ([5, 7], False), ([1, 174], False), ([1, 2, 3], False)])
def test_adjacent_tracks(spark, tracks, ok):
    df = spark.createDataFrame([(tracks,)], "t array<int>")
    assert df.select(ia.tracks_adjacent(F.col("t"))).first()[0] is ok


def test_routing_and_resume(spark):
    rows = spark.createDataFrame([("P", "A", False, t, "") for t in (ia.TRACKS, ia.PRE_LOST, ia.POST_MORE, ia.MISMATCH, ia.BURSTS, ia.SPAN)] + [("Q", "A", True, "", ""), ("R", "A", None, ia.UNREAD, "x")], schemas.RESULTS)
    bad = ia.incorrect(rows)
    assert bad.count() == 7
    assert {r.issue_type for r in ia.pre_issues(bad).collect()} == {ia.TRACKS, ia.PRE_LOST, ia.MISMATCH}
    assert {r.issue_type for r in ia.post_issues(bad).collect()} == {ia.POST_MORE, ia.SPAN}
    tags = spark.createDataFrame([(p, "", "A", "", "", "") for p in "PRS"], schemas.TAGS)
    assert {r.opera_id for r in ia.resume(tags, rows).collect()} == {"S"}
    assert {r.opera_id for r in ia.resume(tags, rows, retry_errors=True).collect()} == {"R", "S"}


def test_online(spark):
    tags = spark.createDataFrame([("P", "", "A", f"{PRE1},{PRE2}", f"{NOW1},{NOW2}", ""), ("Q", "", "A", PRE1, NOW1, ""), ("R", "E: x", "A", "", "", "")], schemas.TAGS)
    own = expected(spark).drop("product_id").withColumn("product", F.lit("P")).withColumn("error", F.lit(""))
    failed = own.limit(1).withColumn("product", F.lit("Q")).withColumn("error", F.lit("Timeout: y"))
    got = {r.opera_id: (r.inputs_correct, r.issue_type) for r in ia.online_comparison(tags, own.unionByName(failed)).collect()}
    assert got == {"P": (True, ""), "Q": (None, ia.ENUMERATION), "R": (None, ia.UNREAD)}


def test_errors_of_products_audited_later_do_not_count(spark):
    rows = [("P1", "T", None, ia.UNREAD, "x"), ("P1", "T", True, "", ""), ("P2", "T", None, ia.ENUMERATION, "y"), ("P2", "T", None, ia.ENUMERATION, "y"), ("P3", "T", False, ia.BURSTS, "z")]
    got = ia.settled(spark.createDataFrame(rows, schemas.RESULTS))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[1], rows[2], rows[4]], key=str)
