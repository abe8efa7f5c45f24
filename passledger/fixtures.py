"""The audits' tables derived from the generic test tables, with planted defects.

All are lazy, and nothing of them is kept: a query reads only what it needs of them.
Orders stand for products, their lines for input granules, customers in fours for tiles.
`queries` holds the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passledger.functions import ids
from passledger.operators import dedup
from passledger.operators.enumerate import build_expected_products
from passledger.operators.frame import build_input_frame

START, STOP = "1999-01-01", "2001-01-01"
BASE_URL = "https://data.example.org/inputs/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tile(n: Column) -> Column:
    return F.lpad(n.cast("string"), 5, "0")


def _stamp(t: Column) -> Column:
    return F.date_format(t, "yyyyMMdd'T'HHmmss'Z'")


def _later(t: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("int"), t)


def _square(n: Column) -> tuple[Column, Column]:
    return F.lit(-180) + n % 360, F.lit(-60) + F.floor(n / 360) % 120


def _wkt(lon: Column, lat: Column) -> Column:
    corner = lambda x, y: F.concat((lon + x).cast("string"), F.lit(" "), (lat + y).cast("string"))
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1), corner(0, 0)), F.lit("))"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders but every eleventh; some are processed 90 days late."""
    o = table(spark, sf_dir, "orders").where("o_orderkey % 11 <> 0").withColumn("n", F.floor(F.col("o_custkey") / 4))
    k = F.col("o_orderkey")
    late = F.lit(21_600) + k % 97 * 540 + F.when(k % 37 == 0, 7_776_000).otherwise(0)
    o = o.withColumn("acq_time", F.col("o_orderdate").cast("timestamp_ntz")).withColumn("processing_time", _later(F.col("acq_time"), late).cast("timestamp_ntz"))
    o = o.withColumn("mgrs_tile_id", _tile(F.col("n"))).withColumn("sat", F.concat(F.lit("S"), k.cast("string")))
    o = o.withColumn("opera_id", F.concat(F.lit("FX_L3_ALERT_T"), F.concat_ws("_", "mgrs_tile_id", _stamp(F.col("acq_time")), _stamp(F.col("processing_time")), "sat")))
    url = F.concat(F.lit("https://data.example.org/products/"), "opera_id", F.lit("/"), "opera_id", F.lit("_STATUS.tif"))
    lon, lat = _square(F.col("n"))
    return o.select("opera_id", "mgrs_tile_id", "acq_time", "processing_time", "sat", F.when(k % 41 != 0, url).alias("alert_url"), ids.truncated("opera_id").alias("opera_dedup_id"), _wkt(lon, lat).alias("geometry"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines (k, line) with the tile number and the date of their order."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.floor(F.col("o_custkey") / 4).alias("n"), "o_orderdate")
    return li.join(o, "k")


def _track(n: Column) -> Column:
    return (1 + n % 175).cast("int")


def _burst(n: Column, beam: Column) -> Column:
    return F.concat(F.lit("T"), F.lpad(_track(n).cast("string"), 3, "0"), F.lit("-"), F.lpad(n.cast("string"), 6, "0"), F.lit("-IW"), (1 + beam).cast("string"))


def raw_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A granule for each line of an order; lines repeat."""
    k, line, n = F.col("k"), F.col("line"), F.col("n")
    df = _lines(spark, sf_dir).withColumn("track_number", _track(n)).withColumn("jpl_burst_id", _burst(n, line % 3))
    df = df.withColumn("acq_dt", _later(F.col("o_orderdate").cast("timestamp"), 3 * line)).withColumn("processing_dt", _later(F.col("acq_dt"), 10_800 + k))
    df = df.withColumn("opera_id", F.concat(F.lit("FX_L2_RTC_"), F.concat_ws("_", "jpl_burst_id", _stamp(F.col("acq_dt")), _stamp(F.col("processing_dt")), F.lit("S1A"))))
    pol = F.when((k + line) % 10 == 0, "VV").when(k % 3 == 0, "HH+HV").otherwise("VV+VH")
    return df.select("opera_id", "jpl_burst_id", "acq_dt", "processing_dt", "track_number", pol.alias("polarizations"), ids.truncated("opera_id").alias("opera_dedup_id"), F.when(k % 53 != 0, F.lit("POLYGON ((0 0, 1 0, 1 1, 0 0))")).alias("geometry"), n.alias("n"))


def inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.deduplicate_inputs(raw_inputs(spark, sf_dir))


def _bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(jpl_burst_id, n): every acquisition has one granule that stays, so that lines tell all bursts."""
    beams = _lines(spark, sf_dir).select("n", (F.col("line") % 3).alias("beam")).distinct()
    return beams.select(_burst(F.col("n"), F.col("beam")).alias("jpl_burst_id"), "n")


def lut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each burst's tile, and for -IW1 bursts the next tile as well."""
    n = F.explode(F.when(F.col("jpl_burst_id").endswith("-IW1"), F.array("n", F.col("n") + 1)).otherwise(F.array("n")))
    return _bursts(spark, sf_dir).select("jpl_burst_id", n.alias("n")).select("jpl_burst_id", _tile(F.col("n")).alias("mgrs_tile_id"))


def burst_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines of bursts; every seventh number is not known."""
    lon, lat = _square(F.col("n"))
    return _bursts(spark, sf_dir).where("n % 7 <> 0").select("jpl_burst_id", _wkt(lon, lat).alias("geometry"))


def boxes(df: DataFrame, name: str) -> DataFrame:
    """(name, n) as the bounds of degree squares."""
    lon, lat = _square(F.col("n"))
    return df.select(name, *[c.cast("double").alias(a) for a, c in (("lon_min", lon), ("lat_min", lat), ("lon_max", lon + 1), ("lat_max", lat + 1))])


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / 4).alias("n")).distinct()
    return boxes(n.withColumn("mgrs_tile_id", _tile(F.col("n"))), "mgrs_tile_id")


def tile_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines of tiles; every seventh is not known."""
    n = table(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / 4).alias("n")).distinct().where("n % 7 <> 0")
    lon, lat = _square(F.col("n"))
    return n.select(_tile(F.col("n")).alias("mgrs_tile_id"), _wkt(lon, lat).alias("geometry"))


def fine_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A triangle for each tile, with all decimals that a double has."""
    n = table(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / 4).alias("n")).distinct()
    x, y = F.col("n") % 360 - 180 + F.col("n") % 977 / 977, F.col("n") % 170 - 85 - F.col("n") % 983 / 983
    corner = lambda a, b: F.concat(a.cast("string"), F.lit(" "), b.cast("string"))
    shape = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", corner(x, y), corner(x + 0.5, y), corner(x, y + 0.25), corner(x, y)), F.lit("))"))
    return n.select(_tile(F.col("n")).alias("mgrs_tile_id"), shape.alias("geometry"))


def shapes_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each product's time and outline: a square, a square after a smaller one, or none."""
    df = products(spark, sf_dir).withColumn("k", F.substring("sat", 2, 20).cast("long"))
    two = F.concat(F.lit("MULTIPOLYGON (((0 0, 0.5 0, 0.5 0.5, 0 0)), "), F.substring(F.col("geometry"), 9, 10_000), F.lit(")"))
    shape = F.when(F.col("k") % 7 == 0, two).when(F.col("k") % 9 != 0, F.col("geometry"))
    return df.select("opera_id", "acq_time", shape.alias("geometry"))


def _item(identifier: Column, urls: Column, attributes: Column) -> Column:
    umm = F.struct(identifier.alias("GranuleUR"), F.transform(F.array_compact(urls), lambda u: F.struct(u.alias("URL"))).alias("RelatedUrls"), attributes.alias("AdditionalAttributes"))
    return F.to_json(F.struct(umm.alias("umm"))).alias("item")


def product_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as a search gives them, some without a layer."""
    i, k = F.col("opera_id"), F.substring("sat", 2, 20).cast("long")
    file = lambda scheme, end: F.concat(F.lit(f"{scheme}://data.example.org/products/"), i, F.lit("/"), i, F.lit(end))
    urls = [file("s3", "_GEN-DIST-STATUS.tif"), file("https", ".png"), F.when(k % 41 != 0, file("https", "_GEN-DIST-STATUS.tif"))]
    urls += [F.when(k % 2 == 0, file("https", "_GEN-DIST-STATUS-ACQ.tif")), F.when(k % 3 != 0, file("https", "_GEN-METRIC.tif"))]
    return products(spark, sf_dir).select(_item(i, F.array(*urls), F.lit(None).cast("array<struct<Name:string,Values:array<string>>>")))


def input_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs as a search gives them; those of every fiftieth tile have no attributes."""
    g = raw_inputs(spark, sf_dir).select("opera_id", "polarizations", "n").distinct()
    channels = F.reverse(F.split("polarizations", "[+]"))
    file = lambda c: F.concat(F.lit(BASE_URL), F.col("opera_id"), F.lit("/"), F.col("opera_id"), F.lit("_"), c, F.lit(".tif"))
    named = F.array(F.struct(F.lit("OTHER").alias("Name"), F.array(F.lit("x")).alias("Values")), F.struct(F.lit("POLARIZATION").alias("Name"), channels.alias("Values")))
    return g.select(_item(F.col("opera_id"), F.transform(channels, file), F.when(F.col("n") % 50 != 0, named)))


def bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes(_bursts(spark, sf_dir), "jpl_burst_id")


def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_input_frame(inputs(spark, sf_dir).drop("n"), lut(spark, sf_dir))


def expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_expected_products(frame(spark, sf_dir))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tags(spark, sf_dir, expected(spark, sf_dir))


def _tags(spark: SparkSession, sf_dir: str, expected: DataFrame) -> DataFrame:
    """Recorded tags: expected inputs and the previous product, but for planted defects."""
    p = dedup.deduplicate_products(products(spark, sf_dir))
    chain = Window.partitionBy("mgrs_tile_id").orderBy("acq_time", "opera_id")
    k = F.substring("sat", 2, 20).cast("long")
    prior = F.coalesce(F.when(k % 23 == 0, F.lag("opera_id", 2).over(chain)).otherwise(F.lag("opera_id", 1).over(chain)), F.lit(""))
    prior = F.when((prior != "") & (k % 5 == 0), F.concat(F.lit("some/folder/"), prior)).otherwise(prior)
    p = p.withColumn("prior_product", prior).withColumn("k", k).where("k % 29 <> 0")
    track = (1 + F.col("mgrs_tile_id").cast("int") % 175).cast("string")
    p = p.withColumn("product_id", F.concat_ws("/", "mgrs_tile_id", track, F.datediff(F.col("acq_time"), F.lit("1970-01-01").cast("date")).cast("string")))
    own = expected.groupBy("product_id").agg(*[F.sort_array(F.collect_set(F.when(F.col("input_category") == c, F.col("opera_id")))).alias(c) for c in ("pre", "post")])
    p = p.join(own, "product_id", "left").withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in ("pre", "post")})
    pre, post = F.col("pre"), F.col("post")
    pre = F.when((F.col("k") % 13 == 0) & (F.size(pre) > 0), F.slice(pre, 2, 1_000_000)).otherwise(pre)
    pre = F.when(F.col("k") % 43 == 0, F.concat(pre, F.array(F.lit("FX_L2_RTC_T002-000001-IW1_19980101T000000Z_19980102T000000Z_S1A")))).otherwise(pre)
    post = F.when((F.col("k") % 19 == 0) & (F.size(post) > 1), F.slice(post, F.lit(1), F.size(post) - 1)).otherwise(post)
    span = F.concat(F.lit("FX_L2_RTC_T009-000001-IW2_"), _stamp(_later(F.col("acq_time"), F.lit(270_000))), F.lit("_20020101T000000Z_S1A"))
    post = F.when((F.col("k") % 47 == 0) & (F.size(post) > 0), F.concat(post, F.array(span))).otherwise(post)
    post = F.when(F.col("k") % 59 == 0, F.concat(post, F.array(F.lit("bad_id")))).otherwise(post)
    error = F.when(F.col("k") % 31 == 0, F.lit("OSError: unreadable")).otherwise(F.lit(""))
    keep = lambda c: F.when(error == "", c).otherwise(F.lit(""))
    return p.select("opera_id", error.alias("error"), "mgrs_tile_id", keep(F.array_join(pre, ",")).alias("pre_rtc_opera_ids"), keep(F.array_join(post, ",")).alias("post_rtc_opera_ids"), keep(F.col("prior_product")).alias("prior_product"))
