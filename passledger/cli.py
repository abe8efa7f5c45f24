"""Command line: download-metadata, fetch-tags, the checks, and run-all."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession

from passledger.operators import aoi, dedup
from passledger.plans.run import Run, run_checks
from passledger.sources import granules, tables, tags

CHECKS = {"check-duplicates": "duplicates", "check-ordering": "ordering", "check-confirmation": "confirmation", "check-inputs": "inputs", "check-coverage": "coverage"}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="passledger", description=__doc__)
    commands = out.add_subparsers(dest="command", required=True)

    def add(name: str, text: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=text)
        p.add_argument("--data-dir", default="data")
        p.add_argument("--dims", default="", help="folder with tiles, bursts and lut (default: the data folder)")
        p.add_argument("--seed", type=int, default=42)
        return p

    def searching(p: argparse.ArgumentParser) -> None:
        p.add_argument("--start", required=True)
        p.add_argument("--stop", required=True)
        p.add_argument("--bbox", type=float, nargs=4)
        p.add_argument("--lookback", action=argparse.BooleanOptionalAction, default=True)
        p.add_argument("--skip-inputs", action="store_true")
        p.add_argument("--chunk-days", type=int, default=2)
        for name in ("url", "product-collection", "input-collection", "token"):
            p.add_argument(f"--{name}", default="")
        p.add_argument("--client", default="passledger.sources.granules:http_client")

    def reading(p: argparse.ArgumentParser) -> None:
        p.add_argument("--workers", type=int, default=16)
        p.add_argument("--sample", type=int, default=0)
        p.add_argument("--reader", default="", help="module:function that reads the tags of an address")

    searching(add("download-metadata", "tables of products and inputs from a search service"))
    reading(add("fetch-tags", "tags of product files; goes on where it stopped"))
    for name in [*CHECKS, "run-all"]:
        p = add(name, "all checks, after download and tags" if name == "run-all" else f"the {CHECKS[name]} check")
        p.add_argument("--out-dir", default="outputs")
        p.add_argument("--expect-none-at-start", action="store_true")
        p.add_argument("--sample-tiles", type=int, default=0)
        p.add_argument("--sample-inputs", type=int, default=0)
        if name in ("check-inputs", "run-all"):
            p.add_argument("--retry-errors", action="store_true")
        if name == "run-all":
            searching(p)
            reading(p)
            p.add_argument("--refresh", action="store_true")
        else:
            p.add_argument("--start", default="1900-01-01", required=name == "check-coverage")
            p.add_argument("--stop", default="2100-01-01", required=name == "check-coverage")
    return out


def _dims(spark: SparkSession, a: argparse.Namespace):
    return [spark.read.parquet(f"{a.dims or a.data_dir}/{name}.parquet") for name in ("tiles", "bursts", "lut")]


def _function(path: str):
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def download(spark: SparkSession, a: argparse.Namespace) -> None:
    # What was audited before was audited on other tables.
    tables.forget(spark, f"{a.data_dir}/{tables.RESULTS}")
    tiles, bursts, lut = _dims(spark, a)
    product_box = input_box = None
    wanted = None
    if a.bbox:
        wanted, box = aoi.resolve_target_tiles(aoi.with_bounds(tiles), lut, aoi.with_bounds(bursts), tuple(a.bbox))
        product_box, input_box = ",".join(map(str, a.bbox)), ",".join(str(x) for x in box.first())
    tables.save_target_tiles(wanted, spark, a.data_dir)
    common = {"url": a.url, "token": a.token or None, "client": a.client}
    tables.save(granules.product_table(spark, a.start, a.stop, tiles, a.chunk_days, collection=a.product_collection, bbox=product_box, **common), a.data_dir, tables.PRODUCTS)
    if not a.skip_inputs:
        tables.save(granules.input_table(spark, a.start, a.stop, bursts, a.chunk_days, a.lookback, collection=a.input_collection, bbox=input_box, **common), a.data_dir, tables.INPUTS)


def fetch(spark: SparkSession, a: argparse.Namespace) -> None:
    products = dedup.deduplicate_products(tables.products(spark, a.data_dir))
    products = aoi.sample_rows(products, a.sample, seed=a.seed) if a.sample else products
    found = tags.fetch_tags(spark, products, a.data_dir, _function(a.reader), a.workers)
    print(f"Tags: {found.count()} fetched, {found.where(found.error != '').count()} errors")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("passledger").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if a.command == "download-metadata":
        return download(spark, a)
    if a.command == "fetch-tags":
        return fetch(spark, a)
    if a.command == "run-all":
        have = all(tables.exists(spark, f"{a.data_dir}/{t}") for t in (tables.PRODUCTS, tables.INPUTS))
        if a.refresh or not have:
            download(spark, a)
        if a.reader:
            fetch(spark, a)
    tiles, _, lut = _dims(spark, a)
    run = Run(spark, a.data_dir, tiles, lut, a.sample_tiles, a.seed)
    names = None if a.command == "run-all" else [CHECKS[a.command]]
    run_checks(run, a.out_dir, a.start, a.stop, names, expect_none_at_start=a.expect_none_at_start, sample_inputs=a.sample_inputs, retry_errors=getattr(a, "retry_errors", False))


if __name__ == "__main__":
    main()
