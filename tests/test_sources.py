import json

import pytest
from pyspark.sql import functions as F

from passledger import schemas
from passledger.functions.geometry import rings_of
from passledger.operators import aoi
from passledger.plans import report, sections
from passledger.sources import granules, tables, tags


def test_date_chunks():
    assert [(str(a)[:10], str(b)[:10]) for a, b in aoi.date_chunks("2026-01-01", "2026-01-08", 3)] == [("2026-01-01", "2026-01-04"), ("2026-01-04", "2026-01-07"), ("2026-01-07", "2026-01-08")]
    assert aoi.date_chunks("2026-01-01", "2026-01-01", 3) == aoi.date_chunks("2026-01-02", "2026-01-01", 3) == []


def test_search_follows_cursors_and_retries():
    calls = []

    def client(request, cursor):
        calls.append(cursor)
        if len(calls) == 1:
            return [{"n": 1}], "c1"
        return ([{"n": 2}], "c2") if cursor == "c1" else ([], None)

    assert [x["n"] for x in granules.search(client, {})] == [1, 2] and calls == [None, "c1", "c2"]
    tries = []

    def broken():
        tries.append(1)
        raise OSError("no")

    with pytest.raises(OSError):
        granules.with_retries(broken, 3, sleep=lambda s: None)
    assert len(tries) == 3


def fake_client(request, cursor):
    start = request["params"]["temporal"][:10].replace("-", "")
    item = {"umm": {"GranuleUR": f"FX_L3_A_T01ABC_{start}T000000Z_{start}T060000Z_S1A", "RelatedUrls": [{"URL": "s3://x/y_GEN-METRIC.tif"}, {"URL": "https://x/y_GEN-METRIC.tif"}, {"URL": "https://x/y_GEN-DIST-STATUS.tif"}]}}
    other = {"umm": {"GranuleUR": f"FX_L2_R_T012-000001-IW1_{start}T000000Z_{start}T060000Z_S1A", "RelatedUrls": [{"URL": "https://x/a_VH.tif"}, {"URL": "https://x/a_VV.tif"}], "AdditionalAttributes": [{"Name": "POLARIZATION", "Values": ["VV", "VH"]}]}}
    return ([item, item], "next") if cursor is None else ([other], None)


def test_granule_source(spark):
    items = granules.search_items(spark, "2026-01-01", "2026-01-08", 3, client="tests.test_sources:fake_client")
    assert items.count() == 9
    products = granules.parse_products(items).where("mgrs_tile_id = '01ABC'").distinct()
    assert products.count() == 3
    p = products.orderBy("acq_time").first()
    assert (p.metric_url, p.alert_url, p.alert_acq_url) == ("https://x/y_GEN-METRIC.tif", "https://x/y_GEN-DIST-STATUS.tif", None)
    i = granules.parse_inputs(items).where("track_number = 12").first()
    assert (i.polarizations, i.url_copol, i.url_crosspol, i.jpl_burst_id) == ("VV+VH", "https://x/a_VV.tif", "https://x/a_VH.tif", "T012-000001-IW1")
    assert granules.search_items(spark, "2026-01-01", "2026-01-01", 3, client="tests.test_sources:fake_client").count() == 0


def read_tags(url):
    if "bad" in url:
        raise OSError("unreadable")
    return {"mgrs_tile_id": "A", "pre_rtc_opera_ids": url}


def test_tags_resume(spark, tmp_path):
    products = spark.createDataFrame([("P1", "good"), ("P2", "bad"), ("P3", None)], "opera_id string, alert_url string")
    got = {r.opera_id: r for r in tags.fetch_tags(spark, products, str(tmp_path), read_tags, 2, 1, attempts=1).collect()}
    assert set(got) == {"P1", "P2"} and got["P1"].pre_rtc_opera_ids == "good" and got["P1"].prior_product == "" and got["P2"].error == "OSError: unreadable"
    again = tags.fetch_tags(spark, products.withColumn("alert_url", F.lit("good now")), str(tmp_path), read_tags, 2, 10, attempts=1)
    assert {(r.opera_id, r.error, r.pre_rtc_opera_ids) for r in again.collect()} == {("P1", "", "good"), ("P2", "", "good now"), ("P3", "", "good now")}


def test_missing_table_names_the_command(spark, tmp_path):
    with pytest.raises(tables.MissingTable, match="fetch-tags"):
        tables.tags(spark, str(tmp_path))
    assert tables.target_tiles(spark, str(tmp_path)) is None
    tables.save_target_tiles(spark.createDataFrame([("B",), ("A",)], "mgrs_tile_id string"), spark, str(tmp_path))
    assert {r[0] for r in tables.target_tiles(spark, str(tmp_path)).collect()} == {"A", "B"}
    tables.save_target_tiles(None, spark, str(tmp_path))
    assert tables.target_tiles(spark, str(tmp_path)) is None


def test_section_and_report(spark, tmp_path):
    bad = spark.createDataFrame([(f"P{i}", "AB"[i % 2], "</script>" if i else None) for i in range(5)], "opera_id string, mgrs_tile_id string, note string")
    tiles = spark.createDataFrame([("A", "POLYGON ((0 0, 1 0, 1 1, 0 0))")], "mgrs_tile_id string, geometry string")
    s = sections.build_section("k", "Title", "text", bad, 9, bad.groupBy("mgrs_tile_id").agg(F.count("*").alias("n_rows")), "Sums", tiles, ["opera_id"], most=3)
    assert (s.n_failures, s.n_checked, s.truncated, len(s.records)) == (5, 9, True, 3)
    assert [f["n_failures"] for f in s.features] == [2] and s.summary["records"][0] == {"mgrs_tile_id": "A", "n_rows": 3}
    path = report.write_report([s], str(tmp_path / "r.html"), "a <b>", "sub")
    text = open(path, encoding="utf-8").read()
    assert "<title>a &lt;b&gt;</title>" in text
    data = text.split('type="application/json">')[1].split("</script>")[0]
    assert json.loads(data)["sections"][0]["records"][1]["note"] == "</script>"


def test_several_outlines_of_a_tile_multiply_no_rows(spark):
    bad = spark.createDataFrame([("P0", "A"), ("P1", "A"), ("P2", "B"), ("P3", "C"), ("P4", "D")], "opera_id string, mgrs_tile_id string")
    one, two, both = "POLYGON ((0 0, 1 0, 1 1, 0 0))", "POLYGON ((5 5, 6 5, 6 6, 5 5), (5.5 5.2, 5.6 5.2, 5.6 5.3, 5.5 5.2))", "MULTIPOLYGON (((7 7, 8 7, 8 8, 7 7)), ((9 9, 9.5 9, 9 9.5, 9 9)))"
    tiles = spark.createDataFrame([("A", one), ("A", two), ("A", both), ("A", one), ("B", one), ("B", None), ("C", None), ("C", None)], "mgrs_tile_id string, geometry string")
    whole = f"MULTIPOLYGON ({both[14:-1]}, {one[8:]}, {two[8:]})"
    assert [len(x) for x in rings_of(whole)] == [1, 1, 1, 2]
    s = sections.build_section("k", "T", "d", sections.with_tile_wkt(bad, tiles), 5, tiles=tiles, order=["opera_id"])
    assert s.n_failures == 5 and [(r["opera_id"], r["mgrs_tile_wkt"]) for r in s.records] == [("P0", whole), ("P1", whole), ("P2", one), ("P3", None), ("P4", None)]
    assert sorted((f["mgrs_tile_id"], f["n_failures"], f.get("geometry")) for f in s.features) == [("A", 2, whole), ("B", 1, one), ("C", 1, None)]


def test_empty_section(spark):
    s = sections.build_section("k", "T", "d", schemas.empty(spark, schemas.RESULTS), 0)
    assert (s.n_failures, s.records, s.summary) == (0, [], None) and "issue_type" in s.columns


def test_run_all(spark, tmp_path, sf_dir):
    """Every check on files, with a resumed inputs audit."""
    from passledger import cli, fixtures as fx

    d = str(tmp_path / "data")
    granules_ = fx.inputs(spark, sf_dir)
    tables.save(fx.products(spark, sf_dir).withColumns({"metric_url": F.lit(None).cast("string"), "alert_acq_url": F.lit(None).cast("string")}), d, tables.PRODUCTS)
    tables.save(granules_.drop("n").withColumns({"url_copol": F.lit(""), "url_crosspol": F.lit("")}), d, tables.INPUTS)
    tables.save(fx.tags(spark, sf_dir), d, tables.TAGS)
    tables.save(fx.lut(spark, sf_dir), d, "lut.parquet")
    tables.save(fx.products(spark, sf_dir).select("mgrs_tile_id", "geometry").distinct(), d, "tiles.parquet")
    tables.save(granules_.select("jpl_burst_id", "geometry").distinct(), d, "bursts.parquet")
    out = tmp_path / "out"
    cli.main(["run-all", "--data-dir", d, "--out-dir", str(out), "--start", fx.START, "--stop", fx.STOP, "--sample-tiles", "6"], spark)
    names = {p.name.rsplit("_", 1)[0] for p in out.iterdir()}
    assert {"duplicates", "ordering", "ordering_failures", "confirmation_failures", "confirmation_tiles", "inputs", "inputs_failures", "inputs_failures_post", "inputs_failures_pre", "coverage", "coverage_missing", "coverage_missing_by_tile", "coverage_orphans", "report"} <= names
    before = spark.read.parquet(f"{d}/{tables.RESULTS}").count()
    cli.main(["check-inputs", "--data-dir", d, "--out-dir", str(out), "--sample-tiles", "6"], spark)
    assert spark.read.parquet(f"{d}/{tables.RESULTS}").count() == before


def test_streams(spark, tmp_path):
    from passledger.streaming import audits

    schema = "opera_id string, mgrs_tile_id string, acq_time timestamp, processing_time timestamp, opera_dedup_id string"
    rows = [("P1", "A", "2026-01-01", "2026-01-05", "a"), ("P2", "A", "2026-01-02", "2026-01-03", "b"), ("P2", "A", "2026-01-02", "2026-01-03", "b"), ("P3", "A", "2026-01-03", "2026-01-04", "c")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string").selectExpr("a as opera_id", "b as mgrs_tile_id", "cast(c as timestamp) as acq_time", "cast(d as timestamp) as processing_time", "e as opera_dedup_id")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = audits.distinct_products(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("distinct_products").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("distinct_products").count() == 3
    spark.table("distinct_products").coalesce(1).write.parquet(str(tmp_path / "once"))
    ordered = audits.processing_order(spark.readStream.schema(schema).parquet(str(tmp_path / "once")))
    q = ordered.writeStream.format("memory").queryName("ordered").option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert {r.opera_id: r.out_of_order for r in spark.table("ordered").collect()} == {"P1": False, "P2": True, "P3": False}


def test_processing_order_over_several_batches(spark, tmp_path):
    """A product that arrives after later ones is judged, and so is the one that follows it."""
    from passledger.streaming import audits

    schema = "opera_id string, mgrs_tile_id string, acq_time timestamp, processing_time timestamp"
    arrivals = [
        [("B", "2026-01-02", "2026-01-05"), ("D", "2026-01-04", "2026-01-06")],
        [("A", "2026-01-01", "2026-01-07"), ("C", "2026-01-03", "2026-01-05"), ("B", "2026-01-02", "2026-01-05")],
        [("F", "2027-06-01", "2027-06-02")],
        [("E", "2026-01-05", "2026-01-05")],
        [("0", "2025-12-31", "2026-01-09"), ("G", "2027-06-02", "2027-06-01")],
    ]
    (tmp_path / "in").mkdir()
    stream = audits.processing_order(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("late_order").option("checkpointLocation", str(tmp_path / "c")).start()
    for rows in arrivals:
        df = spark.createDataFrame([(a, "T", b, c) for a, b, c in rows], "a string, t string, b string, c string")
        df.selectExpr("a as opera_id", "t as mgrs_tile_id", "cast(b as timestamp) as acq_time", "cast(c as timestamp) as processing_time").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q.processAllAvailable()
    q.stop()
    got = {}
    for r in sorted(spark.table("late_order").collect(), key=lambda r: r.revision):
        got[r.opera_id] = (r.prev_opera_id, r.out_of_order, r.revision, r.too_late)
    assert got == {
        "A": (None, False, 0, False), "B": ("A", True, 1, False), "C": ("B", False, 0, False), "D": ("C", False, 1, False),
        "E": ("D", True, 0, False), "F": ("E", False, 1, False), "0": (None, False, 0, True), "G": ("F", True, 0, False),
    }
    times = {r.opera_id: (str(r.acq_time), str(r.processing_time)) for r in spark.table("late_order").collect()}
    assert times["A"] == ("2026-01-01 00:00:00", "2026-01-07 00:00:00")


def test_versions_are_counted_exactly(spark, tmp_path):
    from passledger.streaming import audits

    schema = "opera_id string, acq_time timestamp, opera_dedup_id string"
    n = 3000
    spark.range(2 * n).selectExpr("concat('P', id % {0}) as opera_id".format(n), "timestamp'2026-01-01' as acq_time", "'a' as opera_dedup_id").coalesce(1).write.parquet(str(tmp_path / "in"))
    counts = audits.version_counts(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    q = counts.writeStream.format("memory").outputMode("complete").queryName("versions").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert [r.n_versions for r in spark.table("versions").collect()] == [n]
