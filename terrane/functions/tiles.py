"""Web-map tile arithmetic as Column expressions; y grows to the south."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrane.functions.geo import point


def _n(z: Column | int) -> Column:
    return F.pow(F.lit(2.0), F.lit(z) if isinstance(z, int) else z)


def _clamp(c: Column, z: Column | int) -> Column:
    return F.greatest(F.lit(0), F.least(_n(z) - 1, F.floor(c))).cast("int")


def tile_x(lon: Column, z: Column | int) -> Column:
    return _clamp((lon + 180) / 360 * _n(z), z)


def tile_y(lat: Column, z: Column | int) -> Column:
    r = F.radians(lat)
    return _clamp((1 - F.ln(F.tan(r) + 1 / F.cos(r)) / math.pi) / 2 * _n(z), z)


def tile_lon(x: Column, z: Column | int) -> Column:
    """Western edge."""
    return x / _n(z) * 360.0 - 180.0


def tile_lat(y: Column, z: Column | int) -> Column:
    """Northern edge."""
    return F.degrees(F.atan(F.sinh(math.pi - 2 * math.pi * y / _n(z))))


def tile_rect(x: Column, y: Column, z: Column | int) -> Column:
    """The closed ring of a tile."""
    w, e, n, s = tile_lon(x, z), tile_lon(x + 1, z), tile_lat(y, z), tile_lat(y + 1, z)
    return F.array(point(w, n), point(w, s), point(e, s), point(e, n), point(w, n))


def flip_row(y: Column, z: Column | int) -> Column:
    """Between rows counted from the north and from the south."""
    return (_n(z) - 1 - y).cast("int")
