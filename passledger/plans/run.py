"""All checks in order, on the tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from passledger.operators import aoi, dedup, inputs_audit
from passledger.operators.enumerate import build_expected_products
from passledger.operators.frame import build_input_frame
from passledger.plans import report, sections
from passledger.sources import tables


@dataclass
class Run:
    """Tables that the checks share; each is made once."""

    spark: SparkSession
    data_dir: str
    tiles: DataFrame
    lut: DataFrame
    sample_tiles: int = 0
    seed: int = 42
    made: dict[str, DataFrame] = field(default_factory=dict)

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.made:
            self.made[name] = make().persist()
        return self.made[name]

    @property
    def products(self) -> DataFrame:
        def make():
            df = tables.products(self.spark, self.data_dir)
            return aoi.sample_tiles(df, self.sample_tiles, self.seed) if self.sample_tiles else df

        return self._once("products", make)

    @property
    def dedup(self) -> DataFrame:
        return self._once("dedup", lambda: dedup.deduplicate_products(self.products))

    @property
    def frame(self) -> DataFrame:
        def make():
            wanted = self.products.select("mgrs_tile_id").distinct() if self.sample_tiles else tables.target_tiles(self.spark, self.data_dir)
            return build_input_frame(tables.inputs(self.spark, self.data_dir), self.lut, wanted)

        return self._once("frame", make)

    @property
    def tags(self) -> DataFrame:
        return self._once("tags", lambda: tables.tags(self.spark, self.data_dir).join(self.dedup.select("opera_id"), "opera_id", "left_semi"))

    def audited(self, sample: int = 0, resume: bool = True, retry_errors: bool = False) -> DataFrame:
        """Results of the inputs audit: those kept from before, and those of products that lack one.

        New results are appended once all of them are made, so that a run that stops keeps those
        of earlier runs only.  With `retry_errors`, products whose only results are errors are
        tried again, and errors of those that then could be audited no longer count.
        """
        tags = aoi.sample_rows(self.tags, sample, seed=self.seed) if sample else self.tags
        path = f"{self.data_dir}/{tables.RESULTS}"
        done = self.spark.read.parquet(path) if resume and tables.exists(self.spark, path) else None
        todo = inputs_audit.resume(tags, done, retry_errors) if done is not None else tags
        new = inputs_audit.check_inputs(todo, self.frame, build_expected_products(self.frame))
        if resume:
            new.write.mode("append").option("compression", "zstd").parquet(path)
            new = self.spark.read.parquet(path)
        return inputs_audit.settled(new.join(tags.select("opera_id").distinct(), "opera_id", "left_semi"))


def checks(run: Run, start: str, stop: str, expect_none_at_start: bool = False, sample_inputs: int = 0, retry_errors: bool = False) -> dict[str, Callable[[], tuple[list, dict]]]:
    """Each check by name, in order."""
    return {
        "duplicates": lambda: sections.duplicates_section(run.products, run.tiles),
        "ordering": lambda: sections.ordering_section(run.dedup, run.tiles),
        "confirmation": lambda: sections.confirmation_section(run.dedup, run.tags, run.tiles, expect_none_at_start),
        "inputs": lambda: sections.inputs_section(run.audited(sample_inputs, retry_errors=retry_errors), run.tiles),
        "coverage": lambda: sections.coverage_section(run.dedup, run.frame, start, stop, run.tiles),
    }


def run_checks(run: Run, out_dir: str, start: str, stop: str, names: list[str] | None = None, title: str = "Production check", **options) -> list:
    """Runs checks, writes CSVs after each, and the report even if one fails."""
    when, made = report.stamp(), []
    todo = checks(run, start, stop, **options)
    try:
        for name in names or todo:
            own, csvs = todo[name]()
            for s in own:
                print(f"{s.title}: {s.n_failures} flagged of {s.n_checked} checked")
            made += own
            report.write_csvs(csvs, out_dir, when)
    finally:
        if made:
            sampled = f" - sample of {run.sample_tiles} tiles" if run.sample_tiles else ""
            report.write_report(made, f"{out_dir}/report_{when}.html", title, f"{start} to {stop}{sampled}")
    return made
