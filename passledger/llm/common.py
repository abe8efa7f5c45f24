"""Helpers shared by the training-text operators: shared storage, lineage cuts, Arrow blocks."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that a Python worker turns into Python objects at one time.
BLOCK_CHARS = 4_000_000
#: Files a core of tables that `stored` keeps in few.
FEW_FILES = 4


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one is set only where a session on one machine names none."""
    own = spark.conf.get("spark.checkpoint.dir", None)
    if own:
        return own.rstrip("/")
    have = spark.sparkContext.getCheckpointDir()
    if have is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="passledger-"))
        have = spark.sparkContext.getCheckpointDir()
    return have.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd", few: bool = False) -> DataFrame:
    """`df` written to the shared folder and read back: a lineage cut that outlives executors.

    With `few`, for narrow rows, into `FEW_FILES` files a core at most: each file costs a task, and
    on local folders the launch of a `chmod` by the executor.
    """
    path = scratch(df.sparkSession, name)
    df = df.coalesce(FEW_FILES * df.sparkSession.sparkContext.defaultParallelism) if few else df
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a scratch path through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(*tables: DataFrame | None) -> None:
    """Deletes tables made by `stored` that nothing reads any more."""
    for table in tables:
        if table is not None:
            remove(table.sparkSession, table.scratch_path)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under internal names; other columns cannot clash."""
    return df.select(*[df[f"`{source}`"].alias(name) for name, source in columns.items()])


def others(df: DataFrame, *results: str) -> list[str]:
    """Columns of `df` but those named like a result, in any case of letters: these give way to it."""
    taken = {n.lower() for n in results}
    return [c for c in df.columns if c.lower() not in taken]


def give_back() -> None:
    """Returns what this process has freed to the system, where its allocators can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not glibc


def frugal(run: Callable) -> Callable:
    """`run` for mapInArrow, and then `give_back`: Python workers outlive their tasks, beside those of later stages."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidy


def text_blocks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_CHARS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each slice holds about `limit` bytes of text, or one longer row."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def utf8_values(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def word_count(text: Column) -> Column:
    """Number of maximal runs without ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
