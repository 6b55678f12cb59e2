"""Great-circle geometry from built-in expressions (no Python in the executors)."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom.constants import EARTH_RADIUS_KM


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km; null when any coordinate is null."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.sin(half_dlat) * F.sin(half_dlat) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.sin(half_dlon) * F.sin(half_dlon)
    # least() skips nulls, so the null test has to come first.
    return F.when(
        chord.isNotNull(), F.asin(F.sqrt(F.least(F.lit(1.0), chord))) * (2 * EARTH_RADIUS_KM)
    )


def cell_lat(lat: Column) -> Column:
    """One-degree row; the pole itself belongs to the last row."""
    return F.least(F.floor(lat), F.lit(89)).cast("int")


def cell_lon(lon: Column) -> Column:
    """One-degree column, wrapped so that 180 and -180 share one."""
    return _wrap(F.floor(lon)).cast("int")


def cell_at(lat: Column, lon: Column, level: int) -> tuple[Column, Column]:
    """Row and column of the cell of 2**-level degrees; cells of a level halve those before."""
    parts = 1 << level
    row = F.least(F.floor(lat * parts), F.lit(90 * parts - 1)).cast("int")
    return row, (F.pmod(F.floor(lon * parts) + 180 * parts, F.lit(360 * parts)) - 180 * parts).cast("int")


def touches(row: Column, column: Column, level: int, lat: Column, lon: Column, radius_km: float) -> Column:
    """Whether the circle around (lat, lon) reaches into a cell of the level."""
    parts, reach = 1 << level, _reach_degrees(radius_km)
    span = _span(lat, reach)
    rows = (row >= F.floor((lat - reach) * parts)) & (row <= F.floor((lat + reach) * parts))
    first = F.floor((lon - span) * parts)
    inside = F.pmod(column - first, F.lit(360 * parts)) <= F.floor((lon + span) * parts) - first
    return rows & (inside | (F.abs(lat) + F.lit(reach) >= 90.0))


def cover_rows(lat: Column, radius_km: float) -> Column:
    """Cell rows touched by a circle around a point at this latitude."""
    reach = _reach_degrees(radius_km)
    low = F.greatest(F.floor(lat - reach), F.lit(-90))
    high = F.least(F.floor(lat + reach), F.lit(89))
    return F.sequence(low.cast("int"), high.cast("int"))


def cover_columns(lat: Column, lon: Column, radius_km: float) -> Column:
    """Cell columns touched by the circle: every column once it holds a pole."""
    reach = _reach_degrees(radius_km)
    span = _span(lat, reach)
    near = F.transform(
        F.sequence(F.floor(lon - span).cast("int"), F.floor(lon + span).cast("int")),
        lambda c: _wrap(c).cast("int"),
    )
    everywhere = F.sequence(F.lit(-180), F.lit(179))
    return F.when(F.abs(lat) + F.lit(reach) >= 90.0, everywhere).otherwise(F.array_distinct(near))


def _span(lat: Column, reach: float) -> Column:
    """Degrees of longitude that a circle of ``reach`` degrees covers on each side."""
    ratio = F.lit(math.sin(math.radians(reach))) / F.cos(F.radians(lat))
    return F.degrees(F.asin(F.least(F.lit(1.0), ratio)))


def _reach_degrees(radius_km: float) -> float:
    # A hair wider than the radius, so rounding never loses a point on the rim.
    return math.degrees(radius_km / EARTH_RADIUS_KM) * (1 + 1e-9) + 1e-9


def _wrap(column: Column) -> Column:
    return F.pmod(column + 180, F.lit(360)) - 180
