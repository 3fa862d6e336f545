"""Geometry as Column expressions. Points are ``struct<lon,lat>``, lines arrays of points, rings closed lines; angles in degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrane.schema import EARTH_RADIUS, PLAIN_RADIUS

#: Fixed-point coordinates: units of a degree, and the world's coarse grid.
FIXED = 100_000
WORLD_COLUMNS, WORLD_ROWS = 512, 256


def point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    dlat, dlon = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    return 2 * EARTH_RADIUS * F.asin(F.sqrt(dlat * dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * dlon * dlon))


def distance_m(a: Column, b: Column) -> Column:
    return haversine_m(a["lon"], a["lat"], b["lon"], b["lat"])


def m_to_deg(m: Column) -> Column:
    return m * 180 / (PLAIN_RADIUS * math.pi)


def m_to_dlon_dlat(lat: Column, m: Column) -> Column:
    turn = F.degrees(m / EARTH_RADIUS)
    return F.struct((turn / F.cos(F.radians(lat))).alias("dlon"), turn.alias("dlat"))


def dist_to_deg(lat: Column, m: Column) -> Column:
    d = m_to_dlon_dlat(lat, m)
    return F.sqrt(d["dlon"] * d["dlon"] + d["dlat"] * d["dlat"])


def offset(lon: Column, lat: Column, dx: Column, dy: Column) -> Column:
    """The point ``dx`` metres east and ``dy`` metres north."""
    return point(lon + F.degrees(dx / EARTH_RADIUS) / F.cos(F.radians(lat)), lat + F.degrees(dy / EARTH_RADIUS))


def rectangle(lon: Column, lat: Column, m: Column) -> Column:
    """The closed ring of a square of half-side ``m`` metres."""
    d = m_to_dlon_dlat(lat, m)
    return F.array(*(point(lon + x * d["dlon"], lat + y * d["dlat"]) for x, y in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))))


def rounded(c: Column, digits: int) -> Column:
    """Rounded as whole units of the last digit, in binary: what ``round`` of doubles gives in most SQL engines."""
    return F.round(c * 10.0**digits) / 10.0**digits


def to_fixed(c: Column) -> Column:
    return F.round(c * FIXED).cast("int")


def to_short(c: Column) -> Column:
    """A small integer; what does not fit is an error, not a wrapped number."""
    return F.when(c.between(-32768, 32767), c).otherwise(F.raise_error(F.concat(F.lit("not a short: "), c.cast("string")))).cast("smallint")


def world_cell(lon: Column, lat: Column) -> Column:
    x = F.least(F.lit(WORLD_COLUMNS - 1), F.floor((lon + 180) * (WORLD_COLUMNS / 360)))
    y = F.least(F.lit(WORLD_ROWS - 1), F.floor((lat + 90) * (WORLD_ROWS / 180)))
    return F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"))


def bbox(coords: Column) -> Column:
    lon, lat = F.transform(coords, lambda p: p["lon"]), F.transform(coords, lambda p: p["lat"])
    return F.struct(F.array_min(lon).alias("min_lon"), F.array_min(lat).alias("min_lat"), F.array_max(lon).alias("max_lon"), F.array_max(lat).alias("max_lat"))


def bbox_center(coords: Column) -> Column:
    b = bbox(coords)
    return point((b["min_lon"] + b["max_lon"]) / 2, (b["min_lat"] + b["max_lat"]) / 2)


def diagonal_m(coords: Column) -> Column:
    b = bbox(coords)
    return haversine_m(b["min_lon"], b["min_lat"], b["max_lon"], b["max_lat"])


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def mean_center(coords: Column) -> Column:
    n = F.size(coords)
    return F.when(n > 0, point(_sum(F.transform(coords, lambda p: p["lon"])) / n, _sum(F.transform(coords, lambda p: p["lat"])) / n))


def segments(coords: Column) -> Column:
    """Neighbouring points of a line, as structs ``a, b``."""
    n = F.size(coords)
    return F.when(n > 1, F.zip_with(F.slice(coords, F.lit(1), n - 1), F.slice(coords, F.lit(2), n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).otherwise(F.array().cast("array<struct<a:struct<lon:double,lat:double>,b:struct<lon:double,lat:double>>>"))


def line_length_m(coords: Column) -> Column:
    return _sum(F.transform(segments(coords), lambda s: distance_m(s["a"], s["b"])))


def line_length_deg(coords: Column) -> Column:
    return _sum(F.transform(segments(coords), lambda s: F.hypot(s["b"]["lon"] - s["a"]["lon"], s["b"]["lat"] - s["a"]["lat"])))


def line_centroid(coords: Column) -> Column:
    """Weighted by the segments' lengths in degrees; the first point of a line without length."""
    size = lambda s: F.hypot(s["b"]["lon"] - s["a"]["lon"], s["b"]["lat"] - s["a"]["lat"])
    segs, total = segments(coords), line_length_deg(coords)
    mid = lambda axis: _sum(F.transform(segs, lambda s: size(s) * (s["a"][axis] + s["b"][axis]) / 2)) / total
    return F.when(total > 0, point(mid("lon"), mid("lat"))).otherwise(F.get(coords, F.lit(0)))


def ring_area(ring: Column) -> Column:
    """Area in square degrees, by the shoelace rule; positive whatever the direction."""
    return F.abs(_sum(F.transform(segments(ring), lambda s: s["a"]["lon"] * s["b"]["lat"] - s["b"]["lon"] * s["a"]["lat"]))) / 2


def ring_area_m2(ring: Column) -> Column:
    """Area in square metres, with degrees scaled at the ring's middle latitude."""
    unit = math.radians(1) * EARTH_RADIUS
    return ring_area(ring) * unit * unit * F.cos(F.radians(bbox_center(ring)["lat"]))


def is_ring(coords: Column) -> Column:
    return (F.size(coords) > 3) & (F.get(coords, F.lit(0)) == F.element_at(coords, -1))


def close_ring(coords: Column) -> Column:
    open_ = F.get(coords, F.lit(0)) != F.element_at(coords, -1)
    return F.when((F.size(coords) > 0) & open_, F.concat(coords, F.slice(coords, 1, 1))).otherwise(coords)


def in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Ray cast to the east: an odd number of crossings is inside. Lower and left edges belong to the ring, upper and right ones do not."""
    crosses = lambda s: ((s["a"]["lat"] > lat) != (s["b"]["lat"] > lat)) & (lon < (s["b"]["lon"] - s["a"]["lon"]) * (lat - s["a"]["lat"]) / (s["b"]["lat"] - s["a"]["lat"]) + s["a"]["lon"])
    return F.aggregate(segments(ring), F.lit(False), lambda a, s: a != F.when((s["a"]["lat"] > lat) == (s["b"]["lat"] > lat), F.lit(False)).otherwise(crosses(s)))


def in_polygon(lon: Column, lat: Column, polygon: Column) -> Column:
    return in_ring(lon, lat, polygon["outer"]) & ~F.coalesce(F.exists(polygon["holes"], lambda h: in_ring(lon, lat, h)), F.lit(False))


def in_geom(lon: Column, lat: Column, geom: Column) -> Column:
    """In any part of a multi-polygon."""
    return F.exists(geom, lambda p: in_polygon(lon, lat, p))


def geom_bbox(geom: Column) -> Column:
    return bbox(F.flatten(F.transform(geom, lambda p: p["outer"])))


def drop_holes(polygon: Column, min_area_m2: float) -> Column:
    return F.struct(polygon["outer"].alias("outer"), F.filter(polygon["holes"], lambda h: ring_area_m2(h) >= min_area_m2).alias("holes"))


def drop_short(parts: Column, m: float = 10.0) -> Column:
    """Lines of a multi-line whose ends are more than ``m`` metres apart."""
    return F.filter(parts, lambda p: distance_m(F.get(p, F.lit(0)), F.element_at(p, -1)) > m)


def nearest_on_segment(lon: Column, lat: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = bx - ax, by - ay
    size = dx * dx + dy * dy
    t = F.when(size == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((lon - ax) * dx + (lat - ay) * dy) / F.when(size == 0, 1.0).otherwise(size))))
    return point(ax + t * dx, ay + t * dy)


def segment_distance_m(lon: Column, lat: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Metres to the nearest point of a segment; nearest by degrees, measured on the sphere."""
    p = nearest_on_segment(lon, lat, ax, ay, bx, by)
    return haversine_m(lon, lat, p["lon"], p["lat"])


def line_distance_m(lon: Column, lat: Column, coords: Column) -> Column:
    ends = F.transform(segments(coords), lambda s: segment_distance_m(lon, lat, s["a"]["lon"], s["a"]["lat"], s["b"]["lon"], s["b"]["lat"]))
    return F.coalesce(F.array_min(ends), haversine_m(lon, lat, F.get(coords, F.lit(0))["lon"], F.get(coords, F.lit(0))["lat"]))


def _side(a: Column, b: Column, c: Column) -> Column:
    return F.signum((b["lon"] - a["lon"]) * (c["lat"] - a["lat"]) - (b["lat"] - a["lat"]) * (c["lon"] - a["lon"]))


def segments_meet(s: Column, e: Column) -> Column:
    """Whether two segments ``a, b`` cross or touch; not if they lie in one line."""
    return (_side(s["a"], s["b"], e["a"]) != _side(s["a"], s["b"], e["b"])) & (_side(e["a"], e["b"], s["a"]) != _side(e["a"], e["b"], s["b"]))


def geom_to_geojson(geom: Column) -> Column:
    """A multi-polygon as GeoJSON text."""
    pair = lambda p: F.array(p["lon"], p["lat"])
    ring = lambda r: F.transform(r, pair)
    body = F.transform(geom, lambda p: F.concat(F.array(ring(p["outer"])), F.transform(F.coalesce(p["holes"], F.array().cast("array<array<struct<lon:double,lat:double>>>")), ring)))
    return F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), body.alias("coordinates")))


def geom_from_geojson(text: Column) -> Column:
    """A multi-polygon from GeoJSON text of a Polygon or MultiPolygon; null for other types."""
    many = F.from_json(text, "type string, coordinates array<array<array<array<double>>>>")
    one = F.from_json(text, "type string, coordinates array<array<array<double>>>")
    parts = F.when(many["type"] == "MultiPolygon", many["coordinates"]).when(one["type"] == "Polygon", F.array(one["coordinates"]))
    ring = lambda r: F.transform(r, lambda p: point(p[0], p[1]))
    return F.transform(parts, lambda p: F.struct(ring(p[0]).alias("outer"), F.transform(F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), ring).alias("holes")))
