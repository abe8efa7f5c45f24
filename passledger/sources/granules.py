"""Granule metadata from a paged search service, as a Spark data source.

Each range of dates is a partition and pages through its own search, so executors share
the work and a lost one repeats only its ranges.  The service is reached by a client,
`module:function`, that takes (request, cursor) and returns (items, next cursor).
"""

from __future__ import annotations

import importlib
import json
import random
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from passledger import schemas
from passledger.functions import ids
from passledger.operators import dedup
from passledger.operators.aoi import date_chunks, lookback_ranges

Page = tuple[list[dict], str | None]
ATTEMPTS, LONGEST_WAIT = 10, 60.0


def iso(t: str | datetime) -> str:
    """...Z; a time without zone is UTC."""
    t = datetime.fromisoformat(t) if isinstance(t, str) else t
    t = t.replace(tzinfo=timezone.utc) if t.tzinfo is None else t.astimezone(timezone.utc)
    return t.strftime("%Y-%m-%dT%H:%M:%SZ")


def with_retries(call: Callable, attempts: int = ATTEMPTS, longest: float = LONGEST_WAIT, sleep: Callable[[float], None] = time.sleep):
    """`call()`, again after random, growing waits; the last error is raised."""
    for n in range(attempts):
        try:
            return call()
        except Exception:
            if n + 1 == attempts:
                raise
            sleep(random.uniform(0, min(longest, 2.0**n)))


def http_client(request: dict, cursor: str | None) -> Page:
    """Pages of JSON with `items`; the cursor travels in a header."""
    headers = {"Authorization": f"Bearer {request['token']}"} if request.get("token") else {}
    if cursor:
        headers[request["cursor_header"]] = cursor
    url = f"{request['url']}?{urllib.parse.urlencode(request['params'])}"
    with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=120) as answer:
        return json.load(answer).get("items", []), answer.headers.get(request["cursor_header"])


def request_of(options: dict[str, str], start: datetime, stop: datetime) -> dict:
    params = {"collection_concept_id": options.get("collection", ""), "temporal": f"{iso(start)},{iso(stop)}", "page_size": options.get("pagesize", str(schemas.PAGE_SIZE))}
    if options.get("bbox"):
        params["bounding_box"] = options["bbox"]
    if options.get("pattern"):
        params |= {"readable_granule_name": options["pattern"], "options[readable_granule_name][pattern]": "true"}
    return {"url": options.get("url", ""), "token": options.get("token"), "cursor_header": options.get("cursorheader", "Search-After"), "params": params}


def search(client: Callable[[dict, str | None], Page], request: dict) -> Iterator[dict]:
    """All items of a search, page by page, until a page is empty or has no cursor."""
    cursor = None
    while True:
        items, cursor = with_retries(lambda c=cursor: client(request, c))
        yield from items
        if not items or cursor is None:
            return


class _Range(InputPartition):
    def __init__(self, start: datetime, stop: datetime):
        super().__init__(None)
        self.start, self.stop = start, stop


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[_Range]:
        return [_Range(a, b) for a, b in date_chunks(self.options["start"], self.options["stop"], int(self.options.get("chunkdays", "3")))] or [_Range(datetime.min, datetime.min)]

    def read(self, partition: _Range) -> Iterator[tuple[str]]:
        if partition.start == partition.stop:
            return
        module, _, name = self.options.get("client", "passledger.sources.granules:http_client").partition(":")
        client = getattr(importlib.import_module(module), name)
        for item in search(client, request_of(self.options, partition.start, partition.stop)):
            yield (json.dumps(item),)


class GranuleSource(DataSource):
    """spark.read.format("granules") with start, stop, chunkDays, url, collection, bbox, pattern, token, client."""

    @classmethod
    def name(cls) -> str:
        return "granules"

    def schema(self) -> str:
        return "item string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


_ITEM = "umm struct<GranuleUR:string,RelatedUrls:array<struct<URL:string>>,AdditionalAttributes:array<struct<Name:string,Values:array<string>>>>"
_LAYERS = {"alert_url": "GEN-DIST-STATUS", "metric_url": "GEN-METRIC", "alert_acq_url": "GEN-DIST-STATUS-ACQ"}


def _parsed(items: DataFrame) -> DataFrame:
    df = items.select(F.from_json("item", _ITEM).alias("i")).select(F.col("i.umm.GranuleUR").alias("opera_id"), F.col("i.umm.RelatedUrls.URL").alias("urls"), F.col("i.umm.AdditionalAttributes").alias("attributes"))
    return df.withColumn("urls", F.filter(F.coalesce("urls", F.array().cast("array<string>")), lambda u: u.startswith("https://") & u.endswith(".tif")))


def _first_ending(*endings: str) -> Column:
    def fits(u: Column) -> Column:
        out = u.endswith(endings[0])
        for e in endings[1:]:
            out = out | u.endswith(e)
        return out

    return F.get(F.filter("urls", fits), F.lit(0))


def parse_products(items: DataFrame) -> DataFrame:
    """Product rows of search items: what the id says, and the address of each layer."""
    df = _parsed(items)
    layers = [_first_ending(f"{suffix}.tif").alias(name) for name, suffix in _LAYERS.items()]
    return df.select("opera_id", ids.tile_id("opera_id").alias("mgrs_tile_id"), ids.acquisition_time_naive("opera_id").alias("acq_time"), ids.processing_time_naive("opera_id").alias("processing_time"), ids.satellite("opera_id").alias("sat"), *layers, ids.truncated("opera_id").alias("opera_dedup_id"))


def polarization_text(values: Column) -> Column:
    """VV+VH or HH+HV for both channels of a kind, else the channels joined by +."""
    v = F.coalesce(values, F.array().cast("array<string>"))
    both = lambda a, b: F.array_contains(v, a) & F.array_contains(v, b)
    return F.when(both("VV", "VH"), "VV+VH").when(both("HH", "HV"), "HH+HV").otherwise(F.array_join(F.array_sort(v), "+"))


def parse_inputs(items: DataFrame) -> DataFrame:
    """Input rows of search items: what the id says, polarizations and addresses of both channels."""
    df = _parsed(items)
    polarization = F.get(F.filter("attributes", lambda a: a["Name"] == "POLARIZATION"), F.lit(0))["Values"]
    burst = ids.burst_id("opera_id")
    return df.select(
        "opera_id", burst.alias("jpl_burst_id"), ids.acquisition_time("opera_id").alias("acq_dt"), ids.processing_time("opera_id").alias("processing_dt"), ids.track_number(burst).alias("track_number"), polarization_text(polarization).alias("polarizations"),
        F.coalesce(_first_ending("_VV.tif", "_HH.tif"), F.lit("")).alias("url_copol"), F.coalesce(_first_ending("_VH.tif", "_HV.tif"), F.lit("")).alias("url_crosspol"), ids.truncated("opera_id").alias("opera_dedup_id"),
    )


def search_items(spark: SparkSession, start: str, stop: str, chunk_days: int, **options: str) -> DataFrame:
    """Items of a search over [start, stop), in ranges of `chunk_days`."""
    spark.dataSource.register(GranuleSource)
    return spark.read.format("granules").options(start=start, stop=stop, chunkDays=str(chunk_days), **{k: v for k, v in options.items() if v is not None}).load()


def product_table(spark: SparkSession, start: str, stop: str, tiles: DataFrame | None = None, chunk_days: int = 7, **options: str) -> DataFrame:
    """Distinct products with their tile's geometry (null where unknown)."""
    from passledger.operators.frame import with_tile_geometry

    df = dedup.distinct_ids(parse_products(search_items(spark, start, stop, max(chunk_days, 7), **options)))
    return with_tile_geometry(df, tiles) if tiles is not None else df.withColumn("geometry", F.lit(None).cast("string"))


def input_table(spark: SparkSession, start: str, stop: str, bursts: DataFrame | None = None, chunk_days: int = 2, lookback: bool = True, **options: str) -> DataFrame:
    """Latest versions of all inputs of [start, stop) and, with `lookback`, of its baseline windows."""
    from passledger.operators.frame import with_burst_geometry

    ranges = [(r["start"], r["stop"]) for r in lookback_ranges(spark, start, stop).orderBy("n").collect()] if lookback else [(start, stop)]
    df = dedup.merge_ranges([parse_inputs(search_items(spark, str(a), str(b), chunk_days, **options)) for a, b in ranges])
    return with_burst_geometry(df, bursts) if bursts is not None else df.withColumn("geometry", F.lit("").cast("string"))
