"""Identifiers: `_`-separated tokens of the last path part.

Token 3 is a tile (with a leading T) or a burst, 4 the acquisition time, 5 the processing
time, 6 the satellite.  Tokens that are missing or malformed give null, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path: ColumnOrName) -> Column:
    """Last part of a path; slashes at its end do not count."""
    return F.substring_index(F.rtrim(_col(path), F.lit("/")), "/", -1)


def token(identifier: ColumnOrName, n: int) -> Column:
    return F.get(F.split(base_name(identifier), "_"), F.lit(n))


def truncated(identifier: ColumnOrName) -> Column:
    """First five tokens: equal for all versions of one acquisition."""
    return F.substring_index(base_name(identifier), "_", 5)


def burst_id(identifier: ColumnOrName) -> Column:
    return token(identifier, 3)


def tile_id(identifier: ColumnOrName) -> Column:
    return F.ltrim(token(identifier, 3), F.lit("T"))


def track_number(burst: ColumnOrName) -> Column:
    """Number in the first `-` part of a burst, after its first letter."""
    part = F.substring_index(_col(burst), "-", 1)
    return F.substring(part, 2, 1_000).try_cast("int")


def _time_text(identifier: ColumnOrName, n: int) -> Column:
    return F.rtrim(token(identifier, n), F.lit("Z"))


def acquisition_time(identifier: ColumnOrName) -> Column:
    """UTC timestamp (the session's zone must be UTC)."""
    return F.try_to_timestamp(_time_text(identifier, 4), F.lit("yyyyMMdd'T'HHmmss"))


def acquisition_time_naive(identifier: ColumnOrName) -> Column:
    return acquisition_time(identifier).cast("timestamp_ntz")


def processing_time(identifier: ColumnOrName) -> Column:
    return F.try_to_timestamp(_time_text(identifier, 5), F.lit("yyyyMMdd'T'HHmmss"))


def processing_time_naive(identifier: ColumnOrName) -> Column:
    return processing_time(identifier).cast("timestamp_ntz")


def satellite(identifier: ColumnOrName) -> Column:
    return token(identifier, 6)


def id_from_url(url: ColumnOrName) -> Column:
    """Name of the folder that holds a file."""
    return F.try_element_at(F.split(F.rtrim(_col(url), F.lit("/")), "/"), F.lit(-2))


def last_part_or_none(path: ColumnOrName) -> Column:
    """What follows the last slash; 'None' if that is empty or the path is null."""
    return F.coalesce(F.nullif(F.substring_index(F.coalesce(_col(path), F.lit("")), "/", -1), F.lit("")), F.lit("None"))


def input_urls(identifier: ColumnOrName, base_url: str, polarizations: ColumnOrName | None = None) -> tuple[Column, Column]:
    """Addresses of an input's two channels; HH and HV where its polarizations say so, else VV and VH."""
    i = _col(identifier)
    horizontal = F.lit(False) if polarizations is None else F.coalesce(_col(polarizations) == "HH+HV", F.lit(False))
    url = lambda a, b: F.concat(F.lit(base_url), i, F.lit("/"), i, F.when(horizontal, F.lit(a)).otherwise(F.lit(b)), F.lit(".tif"))
    return url("_HH", "_VV"), url("_HV", "_VH")


def burst_pol(burst: ColumnOrName = "jpl_burst_id", polarizations: ColumnOrName = "polarizations") -> Column:
    """burst|polarizations; null if either is."""
    return F.concat(_col(burst), F.lit("|"), _col(polarizations))


def not_empty_parts(joined: ColumnOrName) -> Column:
    """Parts of a comma list, without empty ones; null has none."""
    return F.filter(F.split(F.coalesce(_col(joined), F.lit("")), ","), lambda x: x != "")
