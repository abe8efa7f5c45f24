"""Areas, date ranges and samples."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passledger.functions import ids, times
from passledger.functions.geometry import wkt_bounds, wkt_intersects_box, wkt_largest_part
from passledger.schemas import AOI_MARGIN_DEGREES, EARTH, LOOKBACK_DAYS, WINDOW_DAYS

Box = tuple[float, float, float, float]


def with_bounds(df: DataFrame) -> DataFrame:
    """lon_min, lat_min, lon_max, lat_max of the WKT in `geometry`."""
    return df.withColumn("_b", wkt_bounds(F.col("geometry"))).select("*", *[F.col(f"_b.{n}") for n in ("lon_min", "lat_min", "lon_max", "lat_max")]).drop("_b")


def overlaps(box: Box) -> Column:
    """Whether a row's bounds and a box share a point; edges count."""
    west, south, east, north = box
    return (F.col("lon_max") >= west) & (F.col("lon_min") <= east) & (F.col("lat_max") >= south) & (F.col("lat_min") <= north)


def products_over_aoi(products: DataFrame, box: Box, start: str | None = None, stop: str | None = None) -> DataFrame:
    """Products whose geometry meets a box and whose acquisition lies in [start, stop).

    The bounds, read from columns if there are any, decide first; the polygon only for what they leave.
    """
    df = products if "lon_min" in products.columns else with_bounds(products)
    df = df.where(overlaps(box))
    if start is not None:
        df = df.where(F.col("acq_time") >= F.lit(start).cast("timestamp_ntz"))
    if stop is not None:
        df = df.where(F.col("acq_time") < F.lit(stop).cast("timestamp_ntz"))
    return df.where(wkt_intersects_box(F.col("geometry"), *[F.lit(float(x)) for x in box])) if "geometry" in df.columns else df


def tiles_in_box(tiles: DataFrame, box: Box) -> DataFrame:
    return tiles.where(overlaps(box)).select("mgrs_tile_id").distinct()


def widened_box(tiles: DataFrame, lut: DataFrame, bursts: DataFrame, margin: float = AOI_MARGIN_DEGREES) -> DataFrame:
    """One row: bounds of all bursts that feed `tiles`, wider by `margin` and within the earth's."""
    used = lut.join(tiles, "mgrs_tile_id", "left_semi").select("jpl_burst_id").distinct()
    b = bursts.join(used, "jpl_burst_id", "left_semi")
    low = lambda c, least: F.greatest(F.min(c) - margin, F.lit(least)).alias(c)
    high = lambda c, most: F.least(F.max(c) + margin, F.lit(most)).alias(c)
    return b.agg(low("lon_min", EARTH[0]), low("lat_min", EARTH[1]), high("lon_max", EARTH[2]), high("lat_max", EARTH[3]))


def resolve_target_tiles(tiles: DataFrame, lut: DataFrame, bursts: DataFrame, box: Box, margin: float = AOI_MARGIN_DEGREES) -> tuple[DataFrame, DataFrame]:
    """Tiles that a box meets, and the box that holds all their inputs; boxes across 180 degrees are not handled."""
    found = tiles_in_box(tiles, box)
    return found, widened_box(found, lut, bursts, margin)


def tile_totals(products: DataFrame) -> DataFrame:
    """One row: products, and the tiles that they lie in."""
    return products.agg(F.count("*").alias("n_products"), F.count_distinct("mgrs_tile_id").alias("n_tiles"))


def lookback_ranges(spark: SparkSession, start: str, stop: str, days: tuple[int, ...] = LOOKBACK_DAYS, width: int = WINDOW_DAYS) -> DataFrame:
    """Date ranges of inputs needed for the products of [start, stop): baselines in order, then the range itself."""
    begin, end = datetime.fromisoformat(start), datetime.fromisoformat(stop)
    ranges = sorted((begin - timedelta(days=d + width), end - timedelta(days=d)) for d in days) + [(begin, end)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(ranges)], "n int, start timestamp_ntz, stop timestamp_ntz")


def date_chunks(start: str, stop: str, days: int) -> list[tuple[datetime, datetime]]:
    """Consecutive ranges of `days` that share their edges; the last ends at `stop`.  None if start >= stop."""
    edge, end = datetime.fromisoformat(start), datetime.fromisoformat(stop)
    out = []
    while edge < end:
        upto = min(edge + timedelta(days=days), end)
        out.append((edge, upto))
        edge = upto
    return out


def date_chunk_table(spark: SparkSession, start: str, stop: str, days: int) -> DataFrame:
    return spark.createDataFrame([(i, *c) for i, c in enumerate(date_chunks(start, stop, days))], "n int, start timestamp_ntz, stop timestamp_ntz")


def sample_rows(df: DataFrame, n: int, key: str = "opera_id", seed: int = 42) -> DataFrame:
    """`n` rows, the same ones for the same seed."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")).cast("binary")), key).limit(n)


def sample_tiles(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """All rows of `n` tiles."""
    return df.join(F.broadcast(sample_rows(df.select("mgrs_tile_id").distinct(), n, "mgrs_tile_id", seed)), "mgrs_tile_id", "left_semi")


def recorded_inputs(tags: DataFrame, base_url: str, polarizations: DataFrame | None = None) -> DataFrame:
    """Recorded inputs of each product with their time, burst and the addresses of their files."""
    from passledger.operators.inputs_audit import parse_actual_inputs

    df = parse_actual_inputs(tags)
    if polarizations is not None:
        df = df.join(polarizations.select("opera_id_trunc", "polarizations"), "opera_id_trunc", "left")
    co, cross = ids.input_urls("input_id", base_url, "polarizations" if polarizations is not None else None)
    return df.select(F.col("product").alias("product_opera_id"), F.col("input_id").alias("opera_id"), "input_category", ids.acquisition_time_naive("input_id").alias("acq_time"), "jpl_burst_id", co.alias("url_copol"), cross.alias("url_crosspol"))


def search_url(geometry: Column, post: Column, base_url: str) -> Column:
    """Link to a search around a pass: largest polygon of the tile, a day before to a day after; blank without geometry."""
    quoted = F.replace(F.url_encode(wkt_largest_part(geometry)), F.lit("+"), F.lit("%20"))
    day = F.expr("interval 1 day")
    link = F.concat(F.lit(f"{base_url}?polygon="), quoted, F.lit("&start="), times.iso_z(post - day), F.lit("&end="), times.iso_z(post + day), F.lit("&resultsLoaded=true"))
    return F.when(F.coalesce(geometry, F.lit("")) != "", link).otherwise(F.lit(""))
