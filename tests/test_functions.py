from datetime import datetime

import pytest
from pyspark.sql import functions as F

from passledger.functions import geometry, ids, times


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, (str, type(None))) else 'double' if isinstance(v, float) else 'long' if isinstance(v, int) else 'timestamp_ntz'}" for k, v in values.items())).select(column.alias("x")).first()[0]


ID = "FX_L3_ALERT_T00TAB_20260105T142233Z_20260106T000000Z_S1A"


@pytest.mark.parametrize(
    ("make", "want"),
    [
        (ids.truncated, "FX_L3_ALERT_T00TAB_20260105T142233Z"),
        (ids.tile_id, "00TAB"),
        (ids.acquisition_time_naive, datetime(2026, 1, 5, 14, 22, 33)),
        (ids.processing_time_naive, datetime(2026, 1, 6)),
        (ids.satellite, "S1A"),
    ],
)
def test_identifiers(spark, make, want):
    for text in (ID, f"some/folder/{ID}", f"{ID}/"):
        assert one(spark, make("i"), i=text) == want


def test_malformed_identifiers_give_null(spark):
    for column in (ids.burst_id("i"), ids.track_number(ids.burst_id("i")), ids.acquisition_time("i"), ids.satellite("i")):
        for text in ("bad_id", "", None):
            assert one(spark, column, i=text) is None
    assert one(spark, ids.truncated("i"), i="None") == "None"
    assert one(spark, ids.track_number("i"), i="T064-135520-IW1") == 64


def test_last_part(spark):
    for text, want in (("a/b/c", "c"), ("c", "c"), ("a/", "None"), ("", "None"), (None, "None")):
        assert one(spark, ids.last_part_or_none("i"), i=text) == want


def test_urls(spark):
    co, cross = ids.input_urls("i", "https://x/", "p")
    assert one(spark, F.concat_ws(" ", co, cross), i="A", p="HH+HV") == "https://x/A/A_HH.tif https://x/A/A_HV.tif"
    assert one(spark, F.concat_ws(" ", co, cross), i="A", p=None) == "https://x/A/A_VV.tif https://x/A/A_VH.tif"
    assert one(spark, ids.id_from_url("i"), i="https://x/A/A_VV.tif") == "A"


@pytest.mark.parametrize("value", [0.25, 0.15, 0.35, 1.05, 2.5, 1234.55, 0.05])
def test_one_decimal_rounds_as_c(spark, value):
    assert one(spark, times.one_decimal(F.col("v")), v=value) == f"{value:.1f}"


def test_span_text(spark):
    assert one(spark, times.span_text(F.col("v")), v=(2 * 86_400 + 3 * 3600) * 1_000_000) == "2 days 03:00:00"
    assert one(spark, times.span_text(F.col("v")), v=1_000_001) == "0 days 00:00:01.000001"


def test_utc_text(spark):
    assert one(spark, times.utc_text(F.col("v")), v=datetime(2026, 1, 5, 14, 22, 33)) == "2026-01-05 14:22:33+00:00"
    assert one(spark, times.utc_text(F.col("v")), v=datetime(2026, 1, 5, 14, 22, 33, 500)) == "2026-01-05 14:22:33.000500+00:00"


def test_lists(spark):
    assert one(spark, times.int_list(F.array(F.lit(12), F.lit(13))), v=1) == "[12, 13]"
    assert one(spark, times.str_list(F.array(F.lit("a"), F.lit("b"))), v=1) == "['a', 'b']"


SQUARE, HOLED = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))", "POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0), (1 1, 8 1, 8 8, 1 8, 1 1))"


def test_geometry():
    assert geometry.intersects_box(SQUARE, (1, 1, 2, 2))
    assert geometry.intersects_box(SQUARE, (-5, -5, 9, 9))
    assert geometry.intersects_box(SQUARE, (4, 4, 5, 5))
    assert not geometry.intersects_box(SQUARE, (4.1, 4.1, 5, 5))
    assert not geometry.intersects_box("POLYGON ((0 0, 4 0, 0 4, 0 0))", (3, 3, 4, 4))
    assert not geometry.intersects_box(HOLED, (3, 3, 4, 4))
    both = "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 9 5, 9 9.12345, 5 9, 5 5)))"
    assert geometry.largest_part(both) == "POLYGON((5 5,9 5,9 9.1235,5 9,5 5))" or geometry.largest_part(both) == "POLYGON((5 5,9 5,9 9.1234,5 9,5 5))"
    assert geometry.bounds(both) == (0, 0, 9, 9.12345)
