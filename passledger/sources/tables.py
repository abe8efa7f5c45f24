"""Tables in a data folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passledger import schemas

PRODUCTS, INPUTS, TAGS, RESULTS, TILES = "products.parquet", "inputs.parquet", "tags.parquet", "inputs_check_results.parquet", "target_tiles.txt"
#: The command that makes each table, for the message when it is missing.
_MADE_BY = {PRODUCTS: "download-metadata", INPUTS: "download-metadata", TAGS: "fetch-tags"}


class MissingTable(RuntimeError):
    """A table that an earlier command makes is not there."""


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def scan(spark: SparkSession, data_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """A Parquet table of the data folder; with a schema, no file is opened to find it."""
    path = f"{data_dir}/{name}"
    if not exists(spark, path):
        raise MissingTable(f"{path} not found; run {_MADE_BY.get(name, 'the command that makes it')} first")
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        raise MissingTable(f"{path} cannot be read: {e}") from e


def products(spark: SparkSession, data_dir: str) -> DataFrame:
    return scan(spark, data_dir, PRODUCTS, schemas.PRODUCTS)


def inputs(spark: SparkSession, data_dir: str) -> DataFrame:
    return scan(spark, data_dir, INPUTS, schemas.INPUTS)


def tags(spark: SparkSession, data_dir: str) -> DataFrame:
    """Tags of each product: a read that worked wins over one that failed."""
    from pyspark.sql import Window

    best = Window.partitionBy("opera_id").orderBy(F.coalesce(F.col("error") != "", F.lit(True)), "error")
    return scan(spark, data_dir, TAGS, schemas.TAGS).withColumn("_nth", F.row_number().over(best)).where("_nth = 1").drop("_nth")


def target_tiles(spark: SparkSession, data_dir: str) -> DataFrame | None:
    """Tile ids separated by white space; None, for all tiles, without the file."""
    path = f"{data_dir}/{TILES}"
    if not exists(spark, path):
        return None
    words = spark.read.text(path).select(F.explode(F.split("value", r"\s+")).alias("mgrs_tile_id"))
    return words.where("mgrs_tile_id <> ''").distinct()


def forget(spark: SparkSession, path: str) -> None:
    """Deletes a table, if it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def save_target_tiles(tiles: DataFrame | None, spark: SparkSession, data_dir: str) -> None:
    """Keeps the list of tiles for later commands; None forgets it."""
    if tiles is not None:
        tiles.select("mgrs_tile_id").orderBy("mgrs_tile_id").write.mode("overwrite").text(f"{data_dir}/{TILES}")
    else:
        forget(spark, f"{data_dir}/{TILES}")


def save(df: DataFrame, data_dir: str, name: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{data_dir}/{name}")
