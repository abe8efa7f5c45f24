"""Polygons as WKT: what Spark's own functions lack, in batches of distinct geometries."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_RING = re.compile(r"\(([^()]*)\)")
Point = tuple[float, float]


def rings_of(wkt: str) -> list[list[list[Point]]]:
    """Polygons of a POLYGON or MULTIPOLYGON, each a list of rings, the outer one first."""
    body = wkt[wkt.index("(") :]
    parts = re.split(r"\)\s*\)\s*,\s*\(\s*\(", body) if wkt.upper().lstrip().startswith("MULTI") else [body]
    out = []
    for part in parts:
        rings = _RING.findall("(" + part.strip("() \t") + ")")
        out.append([[tuple(map(float, p.split()[:2])) for p in ring.split(",")] for ring in rings])
    return out


def area(ring: list[Point]) -> float:
    return abs(sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]))) / 2


def _inside(x: float, y: float, ring: list[Point]) -> bool:
    odd = False
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
        if (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0:
            odd = not odd
    return odd


def _crosses_box(p: Point, q: Point, box: tuple[float, float, float, float]) -> bool:
    """Whether a segment has a point in a box: its parameter range clipped by the four sides."""
    low, high = 0.0, 1.0
    for axis, (least, most) in enumerate(((box[0], box[2]), (box[1], box[3]))):
        step = q[axis] - p[axis]
        if step == 0:
            if not least <= p[axis] <= most:
                return False
            continue
        a, b = sorted(((least - p[axis]) / step, (most - p[axis]) / step))
        low, high = max(low, a), min(high, b)
    return low <= high


def intersects_box(wkt: str, box: tuple[float, float, float, float]) -> bool:
    """Whether a polygon and a box share a point; edges count, holes do not."""
    for rings in rings_of(wkt):
        if any(_crosses_box(p, q, box) for ring in rings for p, q in zip(ring, ring[1:] + ring[:1])):
            return True
        if _inside(box[0], box[1], rings[0]) and not any(_inside(box[0], box[1], hole) for hole in rings[1:]):
            return True
    return False


def bounds(wkt: str) -> tuple[float, float, float, float]:
    points = [p for rings in rings_of(wkt) for p in rings[0]]
    return min(x for x, _ in points), min(y for _, y in points), max(x for x, _ in points), max(y for _, y in points)


def largest_part(wkt: str) -> str:
    """The polygon with the largest area, four decimals at most, as POLYGON((x y,x y))."""
    text = lambda v: f"{v:.4f}".rstrip("0").rstrip(".")
    rings = max(rings_of(wkt), key=lambda r: area(r[0]) - sum(map(area, r[1:])))
    return "POLYGON(" + ",".join("(" + ",".join(f"{text(x)} {text(y)}" for x, y in ring) + ")" for ring in rings) + ")"


def _intersects(wkt: pd.Series, west: pd.Series, south: pd.Series, east: pd.Series, north: pd.Series) -> pd.Series:
    rows = list(zip(wkt, west, south, east, north))
    known = {r: isinstance(r[0], str) and r[0] != "" and intersects_box(r[0], r[1:]) for r in set(rows)}
    return pd.Series([known[r] for r in rows])


def _bounds(wkt: pd.Series) -> pd.DataFrame:
    known = {w: bounds(w) if isinstance(w, str) and w else (None,) * 4 for w in set(wkt)}
    return pd.DataFrame([known[w] for w in wkt], columns=["lon_min", "lat_min", "lon_max", "lat_max"])


def _largest(wkt: pd.Series) -> pd.Series:
    known = {w: largest_part(w) if isinstance(w, str) and w else None for w in set(wkt)}
    return pd.Series([known[w] for w in wkt])


def wkt_rounded(wkt: Column, decimals: int = 4) -> Column:
    """The text with numbers of `decimals` decimals at most, without zeros at their end."""

    def number(x: Column) -> Column:
        text = F.format_string(f"%.{decimals}f", x.try_cast("double"))
        text = F.regexp_replace(text, r"\.?0+$", "") if decimals else text
        return F.when(x.try_cast("double").isNull(), x).otherwise(F.when(text.isin("-0", ""), F.lit("0")).otherwise(text))

    return F.array_join(F.transform(F.split(wkt, r"(?<=[ (,])(?=[-+.0-9])|(?<=[.0-9])(?=[ ),])"), number), "")


# The functions are made when they are used: workers, which have no session, import this module too.


def wkt_intersects_box(wkt: Column, *box: Column) -> Column:
    return F.pandas_udf(_intersects, "boolean")(wkt, *box)


def wkt_bounds(wkt: Column) -> Column:
    return F.pandas_udf(_bounds, "lon_min double, lat_min double, lon_max double, lat_max double")(wkt)


def wkt_largest_part(wkt: Column) -> Column:
    return F.pandas_udf(_largest, "string")(wkt)
