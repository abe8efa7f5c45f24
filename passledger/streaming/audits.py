"""Versions and processing order of products as they arrive."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from passledger.functions import times

_ORDER = "opera_id string, mgrs_tile_id string, acq_time timestamp, processing_time timestamp, prev_opera_id string, processing_lag_hours double, out_of_order boolean, revision long, too_late boolean"
_NAMES = [c.split()[0] for c in _ORDER.split(", ")]
_HELD = "acq array<long>, opera_id array<string>, proc array<long>, revision array<long>, cut boolean"
#: In place of a missing time: first in order, as a null is.
_NONE = -(1 << 63)


def distinct_products(stream: DataFrame, delay: str = "30 days") -> DataFrame:
    """Each id once, as long as its copies come within `delay` of acquisition time."""
    return stream.withWatermark("acq_time", delay).dropDuplicatesWithinWatermark(["opera_id"])


def version_counts(stream: DataFrame, delay: str = "30 days", window: str = "1 day") -> DataFrame:
    """Versions of each acquisition, final once the watermark has passed its day."""
    df = stream.withWatermark("acq_time", delay)
    return df.groupBy(F.window("acq_time", window), "opera_dedup_id").agg(F.size(F.collect_set("opera_id")).cast("long").alias("n_versions"))


def _next_in_tile(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Puts new acquisitions in their place among those held; judges them and the ones that follow them."""
    *columns, cut = state.get if state.exists else ([], [], [], [], False)
    held = [tuple(h) for h in zip(*columns)]
    changed, too_late = set(), []
    rows = pd.concat(list(batches))
    for own in zip(rows["_acq"].tolist(), rows["opera_id"], rows["_proc"].tolist()):
        at = bisect_left(held, own, key=lambda h: h[:3])
        if at < len(held) and held[at][:3] == own:
            continue  # a copy of a row that is held
        if cut and at == 0:
            too_late.append(own)
            continue
        held.insert(at, (*own, -1))
        changed |= {h[:3] for h in held[at : at + 2]}
    out = [(*own, None, None, False, 0, True) for own in too_late]
    for n, h in enumerate(held):
        if h[:3] in changed:
            prev = held[n - 1] if n else None
            lag = (h[2] - prev[2]) / 3.6e9 if prev and _NONE not in (h[2], prev[2]) else None
            held[n] = (*h[:3], h[3] + 1)
            out.append((*h[:3], prev[1] if prev else None, lag, lag is not None and lag < 0, h[3] + 1, False))
    before = bisect_left(held, state.getCurrentWatermarkMs() * 1000, key=lambda h: h[0])
    kept = held[max(0, before - 1) :]
    state.update((*map(list, zip(*kept)), cut or len(kept) < len(held)))
    df = pd.DataFrame(out, columns=["acq_time", "opera_id", "processing_time", *_NAMES[4:]])
    for c in ("acq_time", "processing_time"):
        df[c] = pd.to_datetime(df[c].where(df[c] != _NONE), unit="us", utc=True)
    yield df.assign(mgrs_tile_id=key[0])[_NAMES]


def processing_order(stream: DataFrame, delay: str = "366 days") -> DataFrame:
    """Products judged against the previous acquisition of their tile, in whatever order they arrive.

    An acquisition that arrives after later ones is judged when it comes, and so is, once
    more, the one that follows it; of several rows of a product the one with the highest
    `revision` holds.  State keeps the acquisitions of a tile since the watermark, which is
    `delay` behind unless `stream` has one, and one before it.  A product acquired before
    these is not judged, and its row is marked `too_late`.  No product is without a row.
    """
    if "spark.watermarkDelayMs" not in stream.schema["acq_time"].metadata:
        stream = stream.withWatermark("acq_time", delay)
    given = stream.select("mgrs_tile_id", "opera_id", "acq_time", *[F.coalesce(times.micros(F.col(c)), F.lit(_NONE)).alias(n) for c, n in (("acq_time", "_acq"), ("processing_time", "_proc"))])
    return given.groupBy("mgrs_tile_id").applyInPandasWithState(_next_in_tile, _ORDER, _HELD, "append", GroupStateTimeout.NoTimeout)
