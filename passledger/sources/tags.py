"""Tags recorded in product files, fetched once and kept.

`read` takes an address and returns a dict of tags; it is tried several times.  A failure
becomes a row with an error, not an exception.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passledger import schemas
from passledger.sources import tables
from passledger.sources.granules import with_retries

#: Columns of the tag table and the keys that product files use for them.
KEYS = {"mgrs_tile_id": "mgrs_tile_id", "pre_rtc_opera_ids": "pre_rtc_opera_ids", "post_rtc_opera_ids": "post_rtc_opera_ids", "prior_product": "prior_product"}
Reader = Callable[[str], dict[str, str]]


def fetch_one(url: str, read: Reader, keys: dict[str, str] = KEYS, attempts: int = 10) -> dict[str, str]:
    try:
        found = with_retries(lambda: read(url), attempts)
        return {"error": "", **{c: found.get(k, "") for c, k in keys.items()}}
    except Exception as e:
        return {"error": f"{type(e).__name__}: {e}", **dict.fromkeys(keys, "")}


def _fetched(read: Reader, keys: dict[str, str], attempts: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [{"opera_id": i, **fetch_one(u, read, keys, attempts)} for i, u in zip(batch["opera_id"], batch["alert_url"])]
            yield pd.DataFrame(rows, columns=["opera_id", "error", *keys])

    return run


def to_fetch(products: DataFrame, have: DataFrame, retry_errors: bool = True) -> DataFrame:
    """Products with an address whose tags are not there, or only with an error to be tried again."""
    kept = have.where("error = ''") if retry_errors else have
    return products.where("alert_url is not null").join(kept.select("opera_id").distinct(), "opera_id", "left_anti").select("opera_id", "alert_url")


def fetch_tags(spark: SparkSession, products: DataFrame, data_dir: str, read: Reader, workers: int = 16, batch: int = schemas.TAG_BATCH, retry_errors: bool = True, keys: dict[str, str] = KEYS, attempts: int = 10) -> DataFrame:
    """Fetches what is missing, in appended batches of about `batch` products, and returns all tags.

    Each batch is committed as a whole, so that an interrupted run goes on where it stopped.
    """
    path = f"{data_dir}/{tables.TAGS}"
    have = tables.tags(spark, data_dir) if tables.exists(spark, path) else schemas.empty(spark, schemas.TAGS)
    todo = to_fetch(products, have, retry_errors)
    left = todo.count()
    n_batches = -(-left // batch)
    if n_batches:
        # Fixed before the first append: what is left must not depend on what has been written.
        todo = todo.withColumn("_batch", F.pmod(F.xxhash64("opera_id"), F.lit(n_batches))).checkpoint() if spark.sparkContext.getCheckpointDir() else todo.withColumn("_batch", F.pmod(F.xxhash64("opera_id"), F.lit(n_batches))).persist()
    for b in range(n_batches):
        own = todo.where(F.col("_batch") == b).drop("_batch").repartition(workers)
        own.mapInPandas(_fetched(read, keys, attempts), schemas.TAGS).write.mode("append").option("compression", "zstd").parquet(path)
    return tables.tags(spark, data_dir) if n_batches or tables.exists(spark, path) else have
