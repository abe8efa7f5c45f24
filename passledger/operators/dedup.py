"""Versions of one acquisition: the one processed last stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def distinct_ids(df: DataFrame, id_col: str = "opera_id") -> DataFrame:
    """One row for each id; rows of an id are copies (searches overlap at their edges)."""
    return df.dropDuplicates([id_col])


def latest_versions(df: DataFrame, processing_col: str = "processing_time", key: str = "opera_dedup_id", id_col: str = "opera_id") -> DataFrame:
    """One row for each `key`, with `n_versions`.

    The latest processing wins, a missing time counts as latest, and the largest id breaks
    ties.  Rows with a null key stay out.
    """
    versions = Window.partitionBy(key)
    newest = versions.orderBy(F.col(processing_col).desc_nulls_first(), F.col(id_col).desc())
    ranked = df.where(F.col(key).isNotNull()).withColumn("n_versions", F.count("*").over(versions)).withColumn("_nth", F.row_number().over(newest))
    return ranked.where("_nth = 1").drop("_nth")


def deduplicate_products(products: DataFrame) -> DataFrame:
    return latest_versions(products)


def deduplicate_inputs(inputs: DataFrame) -> DataFrame:
    """The latest version of each acquisition, once; rows of an id are copies and share their key."""
    return latest_versions(inputs, "processing_dt").drop("n_versions")


def merge_ranges(tables: list[DataFrame]) -> DataFrame:
    """Inputs of several date ranges as one table; a range may be empty."""
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return deduplicate_inputs(out)
