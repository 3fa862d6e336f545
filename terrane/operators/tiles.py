"""Map tiles: covers of polygons, compaction, extracts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions import geo as G
from terrane.functions import tiles as X
from terrane.operators.runs import part_edges

#: Degrees of latitude, just beyond the last row of tiles.
RIM = 85.06


def tile_cover(polygons: DataFrame, max_zoom: int) -> DataFrame:
    """``id, z, x, y``: the tiles of each zoom that meet the polygon (``id, geom``), their sides included.

    A tile of the highest zoom meets it if an edge passes through the tile or its middle is inside. Edges are followed
    from row to row of tiles, and what is inside lies between their crossings of a row's middle line, so neither the
    polygon nor its envelope is held against tiles; lower zooms are parents of these. Rings of one point cover nothing.
    """
    n = 1 << max_zoom
    edge = part_edges(polygons)
    x = lambda lon: (lon + 180) / 360 * n
    row = lambda lat: (1 - F.ln(F.tan(F.radians(lat)) + 1 / F.cos(F.radians(lat))) / math.pi) / 2 * n
    clamp = lambda c: F.greatest(F.lit(0), F.least(F.lit(n - 1), c)).cast("int")
    lo, hi = (F.greatest(F.lit(-RIM), F.least(F.lit(RIM), f("ay", "by"))) for f in (F.least, F.greatest))
    rows = edge.withColumn("y", F.explode(F.sequence(clamp(F.ceil(row(hi)) - 1), clamp(F.floor(row(lo))))))
    # The stretch of longitude that an edge takes within a row.
    at = lambda lat: F.col("ax") + (F.col("bx") - F.col("ax")) * (lat - F.col("ay")) / (F.col("by") - F.col("ay"))
    within = lambda lat: F.greatest(F.least("ay", "by"), F.least(F.greatest("ay", "by"), lat))
    ends = [at(within(X.tile_lat(F.col("y") + k, max_zoom))) for k in (0, 1)]
    flat = F.col("ay") == F.col("by")
    west, east = (F.when(flat, f("ax", "bx")).otherwise(f(*ends)) for f in (F.least, F.greatest))
    passed = rows.withColumn("x", F.explode(F.sequence(clamp(F.ceil(x(west)) - 1), clamp(F.floor(x(east)))))).select("id", "x", "y")
    middle = X.tile_lat(F.col("y") + 0.5, max_zoom)
    met = rows.where((F.col("ay") > middle) != (F.col("by") > middle)).groupBy("id", "part", "y").agg(F.array_sort(F.collect_list(x(at(middle)))).alias("xs"))
    pairs = met.selectExpr("id", "y", "explode(transform(sequence(0, size(xs) div 2 - 1), i -> named_struct('a', ceil(xs[2 * i] - 0.5D), 'b', ceil(xs[2 * i + 1] - 0.5D) - 1))) AS p").where("p.a <= p.b")
    inner = pairs.select("id", F.explode(F.sequence(clamp(F.col("p.a")), clamp(F.col("p.b")))).alias("x"), "y")
    up = passed.union(inner).withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(max_zoom))))
    return up.selectExpr("id", "z", f"shiftright(x, {max_zoom} - z) AS x", f"shiftright(y, {max_zoom} - z) AS y").distinct()


def compact_tiles(tiles: DataFrame, max_zoom: int) -> DataFrame:
    """Four children become their parent, from the highest zoom up to 1; zoom 0 is left out. Columns ``z, x, y`` and any keys.

    Level by level that would be a chain of shuffles. Here every tile adds its area, in tiles of ``max_zoom``, to each of
    its ancestors; an ancestor that is full by that sum replaces what is under it, and the lowest zoom of those counts.
    A tile under another one that is there is dropped.
    """
    keys = [c for c in tiles.columns if c not in ("z", "x", "y")]
    given = tiles.where("z > 0").select(*keys, "z", "x", "y").distinct()
    up = F.floor(F.col("x") / F.pow(F.lit(2.0), F.col("z") - F.col("_z"))), F.floor(F.col("y") / F.pow(F.lit(2.0), F.col("z") - F.col("_z")))
    lines = given.withColumn("_z", F.explode(F.sequence(F.lit(1), F.col("z")))).select(*keys, "z", "x", "y", F.col("_z").cast("int").alias("_z"), *(c.cast("int").alias(n) for c, n in zip(up, ("_x", "_y"), strict=True)))
    above = given.select(*keys, F.col("z").alias("_z"), F.col("x").alias("_x"), F.col("y").alias("_y"))
    under = lines.where("_z < z").join(above, [*keys, "_z", "_x", "_y"], "left_semi").select(*keys, "z", "x", "y").distinct()
    free = lines.join(under, [*keys, "z", "x", "y"], "left_anti")
    area = F.pow(F.lit(4.0), F.lit(max_zoom) - F.col("z")).cast("bigint")
    full = free.groupBy(*keys, "_z", "_x", "_y").agg(F.sum(area).alias("_s")).where(F.col("_s") == F.pow(F.lit(4.0), F.lit(max_zoom) - F.col("_z")).cast("bigint")).drop("_s")
    top = free.join(full, [*keys, "_z", "_x", "_y"]).groupBy(*keys, "z", "x", "y").agg(F.min(F.struct("_z", "_x", "_y")).alias("t"))
    return top.select(*keys, F.col("t._z").alias("z"), F.col("t._x").alias("x"), F.col("t._y").alias("y")).distinct()


def tile_coverage(tiles: DataFrame, key: str = "id") -> DataFrame:
    """``key, geom``: the tiles' rectangles as one multi-polygon."""
    rect = F.struct(X.tile_rect(F.col("x"), F.col("y"), F.col("z")).alias("outer"), F.array().cast("array<array<struct<lon:double,lat:double>>>").alias("holes"))
    return tiles.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("z", "x", "y", rect.alias("r")))).alias("t")).select(key, F.transform("t", lambda t: t["r"]).alias("geom"))


def extract_tiles(tiles: DataFrame, cover: DataFrame, exact: bool = False, from_south: bool = False) -> DataFrame:
    """Stored tiles of a cover. Columns are fetched whole from their least to their greatest row unless ``exact``.

    ``from_south`` is for stores that count rows from the south.
    """
    y = X.flip_row(F.col("y"), F.col("z")) if from_south else F.col("y")
    want = cover.select("z", "x", y.alias("_y"))
    if exact:
        return tiles.join(want.select("z", "x", F.col("_y").alias("y")).distinct(), ["z", "x", "y"], "left_semi")
    span = want.groupBy("z", "x").agg(F.min("_y").alias("_lo"), F.max("_y").alias("_hi"))
    return tiles.join(span, ["z", "x"]).where("y BETWEEN _lo AND _hi").drop("_lo", "_hi")


def tile_metadata(tiles: DataFrame, polygons: DataFrame) -> DataFrame:
    """``name, value`` rows: bounds, centre and zooms of a tile set."""
    b = G.geom_bbox(F.col("geom"))
    box = polygons.select(b.alias("b")).agg(*(f(f"b.{k}").alias(k) for k, f in (("min_lon", F.min), ("min_lat", F.min), ("max_lon", F.max), ("max_lat", F.max))))
    zoom = tiles.agg(F.min("z").alias("minzoom"), F.max("z").alias("maxzoom"))
    text = lambda *cs: F.concat_ws(",", *(F.format_string("%.6f", c) for c in cs))
    one = box.join(zoom, how="cross")  # one row beside one row
    rows = F.array(
        F.struct(F.lit("bounds").alias("name"), text(*(F.col(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat"))).alias("value")),
        F.struct(F.lit("center").alias("name"), text((F.col("min_lon") + F.col("max_lon")) / 2, (F.col("min_lat") + F.col("max_lat")) / 2).alias("value")),
        *(F.struct(F.lit(k).alias("name"), F.col(k).cast("string").alias("value")) for k in ("minzoom", "maxzoom")),
    )
    return one.select(F.inline(rows))
