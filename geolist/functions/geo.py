"""Column functions on coordinates: local projection, distances, segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metres per degree of the local projection and of radius boxes, and the Earth's radius.
METRES_PER_DEGREE = 111_320.0
BOX_METRES_PER_DEGREE = 111_000.0
EARTH_RADIUS = 6_371_000.0


def _num(x: Column | float) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def to_local(lat: Column, lon: Column, lat0: Column | float, lon0: Column | float) -> tuple[Column, Column]:
    """Metres east and north of a centre, on an equirectangular plane."""
    x = (lon - _num(lon0)) * F.lit(METRES_PER_DEGREE) * F.cos(F.radians(_num(lat0)))
    return x, (lat - _num(lat0)) * F.lit(METRES_PER_DEGREE)


def from_local(x: Column, y: Column, lat0: Column | float, lon0: Column | float) -> tuple[Column, Column]:
    """Latitude and longitude of local metres."""
    return _num(lat0) + y / F.lit(METRES_PER_DEGREE), _num(lon0) + x / (F.lit(METRES_PER_DEGREE) * F.cos(F.radians(_num(lat0))))


def segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance of a point to a segment; a segment without length is a point."""
    dx, dy = x2 - x1, y2 - y1
    square = dx * dx + dy * dy
    t = F.when(square > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - x1) * dx + (py - y1) * dy) / square))).otherwise(F.lit(0.0))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def own_or_centre(own: Column, centre: Column) -> Column:
    return F.coalesce(own, centre)


def segments_of(line: Column) -> Column:
    """Consecutive vertices of an array as ``struct(a, b)``, row-local."""
    n = F.size(line) - 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.element_at(line, i.cast("int")).alias("a"), F.element_at(line, (i + 1).cast("int")).alias("b")))).otherwise(F.array())
