"""Joins on time: nearest match, interval membership, distance to the nearest.

All are equi-joins on a key and a time bin with an exact condition on top, or windows over
the rows of both tables in time order, so that no time is compared with all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from passledger.functions import times
from passledger.schemas import LOOKBACK_DAYS, WINDOW_DAYS


def around(t: Column, width_us: int) -> Column:
    """The bin of a time and the bins beside it."""
    b = times.bins(t, width_us)
    return F.array(b - 1, b, b + 1)


def lookback(keys: list[str], t: str, windows: tuple[int, ...] = LOOKBACK_DAYS, width_days: int = WINDOW_DAYS) -> list[WindowSpec]:
    """For each lookback distance d, the rows of the same keys at [t - d - width, t - d); `t` holds microseconds.

    All share one order, so that rows are dealt out and sorted once for all windows and no
    row is repeated for a window.
    """
    order, width = Window.partitionBy(*keys).orderBy(t), width_days * times.DAY
    return [order.rangeBetween(-(d * times.DAY + width), -(d * times.DAY) - 1) for d in windows]


def nearest_distance(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, name: str) -> DataFrame:
    """`left` with the seconds to the nearest time of `right` with the same key; null if there is none.

    One pass over the times of both in order: the last before and the first after.
    """
    rows = left.where(F.col(key).isNotNull()).select(F.col(key), times.micros(F.col(left_time)).alias("_t"), F.lit(None).cast("long").alias("_r"), F.struct(*left.columns).alias("_row"))
    marks = right.where(F.col(key).isNotNull()).select(F.col(key), times.micros(F.col(right_time)).alias("_t")).distinct()
    both = rows.unionByName(marks.withColumn("_r", F.col("_t")), allowMissingColumns=True)
    order = Window.partitionBy(key).orderBy("_t", F.col("_r").asc_nulls_last())
    before = F.last("_r", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first("_r", ignorenulls=True).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    out = both.withColumn(name, F.least(F.col("_t") - before, after - F.col("_t")) / F.lit(1_000_000.0)).where(F.col("_row").isNotNull())
    return out.select("_row.*", name)
