"""The input frame: dual-polarized inputs with their pass, once for each tile they feed.

Joins with tables of tiles and bursts have no hint: Spark broadcasts these where their files,
or their size when they are made, say that they are small, and shuffles them otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passledger.functions import times
from passledger.schemas import DUAL_POLARIZATIONS


def dual_polarized(df: DataFrame) -> DataFrame:
    return df.where(F.col("polarizations").isin(*DUAL_POLARIZATIONS))


def left_out(inputs: DataFrame) -> DataFrame:
    """How many inputs of each polarization the frame leaves out, as they are not dual-polarized; null is one of them."""
    single = ~F.coalesce(F.col("polarizations").isin(*DUAL_POLARIZATIONS), F.lit(False))
    return inputs.where(single).groupBy("polarizations").agg(F.count("*").alias("n_inputs"))


def day_pass(acq: Column) -> Column:
    """Whole days since 1970: one pass a day and track."""
    return times.bins(acq, times.DAY)


def build_input_frame(inputs: DataFrame, lut: DataFrame, tiles: DataFrame | None = None, pass_id: Column | None = None) -> DataFrame:
    """Dual-polarized inputs with geometry, joined to all tiles (or those in `tiles`) that their burst feeds.

    Adds pass_id, mgrs_tile_id, acq_group_id_within_mgrs_tile (the track) and track_token.
    """
    df = dual_polarized(inputs).where(F.col("geometry").isNotNull())
    pairs = lut.select("jpl_burst_id", "mgrs_tile_id").distinct()
    if tiles is not None:
        pairs = pairs.join(tiles.select("mgrs_tile_id").distinct(), "mgrs_tile_id", "left_semi")
    df = df.withColumn("pass_id", day_pass(F.col("acq_dt")) if pass_id is None else pass_id)
    df = df.withColumns({c: F.coalesce(c, F.lit("")) for c in ("url_copol", "url_crosspol") if c in df.columns})
    df = df.join(pairs, "jpl_burst_id")
    return df.withColumn("acq_group_id_within_mgrs_tile", F.col("track_number")).withColumn("track_token", F.col("track_number").cast("string"))


def with_tile_geometry(products: DataFrame, tiles: DataFrame) -> DataFrame:
    """All products, with their tile's geometry where it is known."""
    return products.drop("geometry").join(tiles.select("mgrs_tile_id", "geometry"), "mgrs_tile_id", "left")


def with_burst_geometry(inputs: DataFrame, bursts: DataFrame) -> DataFrame:
    """All inputs, with their burst's geometry where it is known."""
    return inputs.drop("geometry").join(bursts.select("jpl_burst_id", "geometry"), "jpl_burst_id", "left")
