"""Areas on a grid as runs of cells: ``cy, x0, x1`` are the cells of row ``cy`` from ``x0`` to ``x1``.

A cell is a square in degrees, so its width in metres shrinks to the poles and whatever is given in metres is turned
into cells row by row. Runs make this free: their number follows the outline, not the area and not the cells' width.
Windows are over one row of the grid, which the earth's girth bounds. Areas do not wrap round 180 degrees.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.functions import geo as G
from terrane.operators import kernels as K
from terrane.operators.overlay import assemble, trace
from terrane.operators.shared import components, stage

#: Cells of a row that meet those of the next in one join key.
BLOCK = 256


def cell_degrees(cell_m: float) -> float:
    """A cell's side: ``cell_m`` metres of latitude."""
    return math.degrees(cell_m / G.EARTH_RADIUS)


def shrinkage(cell_m: float) -> Column:
    """How much narrower a cell of row ``cy`` is than high; nothing past a pole."""
    return F.greatest(F.lit(0.0), F.cos(F.radians((F.col("cy") + 0.5) * cell_degrees(cell_m))))


def sweep(runs: DataFrame, state: str, keys: tuple[str, ...] = ("cy",), weight: str = "1") -> DataFrame:
    """``keys, x0, x1, state``: the longest runs over which ``state`` (an integer expression of ``v``) keeps a value other than 0.

    ``v`` is the sum of the weights of the runs of equal keys that cover a cell.
    """
    ends = runs.selectExpr(*keys, f"explode(array(named_struct('x', x0, 'd', {weight}), named_struct('x', x1 + 1, 'd', -({weight})))) AS e").select(*keys, "e.x", "e.d")
    row = Window.partitionBy(*keys).orderBy("x")
    level = ends.withColumn("v", F.sum("d").over(row)).selectExpr(*keys, "x", f"CAST({state} AS INT) AS state")  # ends at one x count together
    turn = level.withColumn("_was", F.coalesce(F.lag("state").over(row), F.lit(0))).where("state <> _was")
    return turn.withColumn("x1", F.lead("x").over(row) - 1).where("state <> 0").select(*keys, F.col("x").alias("x0"), "x1", "state")


def merged(runs: DataFrame) -> DataFrame:
    return sweep(runs, "int(v >= 1)").drop("state")


def closed(runs: DataFrame, gap_m: float, cell_m: float) -> DataFrame:
    """Runs after gaps up to ``gap_m`` are closed: grown by half of it along rows, then across, and shrunk in the opposite order."""
    up = max(1, round(gap_m / cell_m / 2))
    # At a pole half the earth's girth is enough; past it there are no metres, and a cell is one.
    girth = 180 / cell_degrees(cell_m)
    narrow = shrinkage(cell_m)
    side = F.when(narrow > 0, F.least(F.lit(girth), F.greatest(F.lit(1.0), F.round(F.lit(gap_m / cell_m / 2) / narrow)))).otherwise(1.0).cast("bigint")
    wide = merged(runs.select("cy", (F.col("x0") - side).alias("x0"), (F.col("x1") + side).alias("x1")))
    across = lambda df: df.select(F.explode(F.sequence(F.col("cy") - up, F.col("cy") + up)).alias("cy"), "x0", "x1")
    high = merged(across(wide))
    low = sweep(across(high), f"int(v = {2 * up + 1})").drop("state")
    return low.select("cy", (F.col("x0") + side).alias("x0"), (F.col("x1") - side).alias("x1")).where("x0 <= x1")


def part_edges(polygons: DataFrame) -> DataFrame:
    """``id, part, ax, ay, bx, by``: the edges of all rings of each part of a polygon (``id, geom``); open rings are closed."""
    none = F.array().cast("array<array<struct<lon:double,lat:double>>>")
    part = polygons.select("id", F.posexplode("geom").alias("part", "p"))
    ring = part.select("id", "part", F.explode(F.concat(F.array("p.outer"), F.coalesce(F.col("p.holes"), none))).alias("r"))
    edge = ring.select("id", "part", F.explode(G.segments(G.close_ring(F.col("r")))).alias("s"))
    return edge.selectExpr("id", "part", "s.a.lon AS ax", "s.a.lat AS ay", "s.b.lon AS bx", "s.b.lat AS by")


def polygon_runs(polygons: DataFrame, cell_m: float) -> DataFrame:
    """``cy, x0, x1``: the cells whose middle is in a polygon (``id, geom``); runs of several parts may overlap.

    Each edge gives the rows whose middle line it crosses the place of that crossing; between the odd and the even ones
    of a part in a row lies its inside. No polygon is sent with its cells.
    """
    d = cell_degrees(cell_m)
    edge = part_edges(polygons)
    first, last = f"CAST(ceil(least(ay, by) / {d!r} - 0.5D) AS BIGINT)", f"CAST(ceil(greatest(ay, by) / {d!r} - 0.5D) AS BIGINT) - 1"
    rows = edge.where(f"{first} <= {last}").selectExpr("*", f"explode(sequence({first}, {last})) AS cy")
    cross = rows.selectExpr("id", "part", "cy", f"(ax + (bx - ax) * ((cy + 0.5D) * {d!r} - ay) / (by - ay)) / {d!r} - 0.5D AS x")
    met = cross.groupBy("id", "part", "cy").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    pairs = met.selectExpr("cy", "explode(transform(sequence(0, size(xs) div 2 - 1), i -> named_struct('a', xs[2 * i], 'b', xs[2 * i + 1]))) AS p")
    return pairs.selectExpr("cy", "CAST(ceil(p.a) AS BIGINT) AS x0", "CAST(ceil(p.b) AS BIGINT) - 1 AS x1").where("x0 <= x1")


def square_runs(points: DataFrame, half_m: float, cell_m: float) -> DataFrame:
    """``cy, x0, x1``: the cells that squares of ``half_m`` metres round points (``lon, lat``) meet.

    A square that reaches round a pole takes half the earth's girth to each side; points past a pole have none.
    """
    d = cell_degrees(cell_m)
    half = G.m_to_dlon_dlat(F.col("lat"), F.lit(half_m))
    at = lambda c: F.floor(c / d).cast("bigint")
    box = points.select("lon", "lat", half.alias("h")).where("h.dlon > 0").withColumn("h", F.struct(F.least(F.lit(180.0), F.col("h.dlon")).alias("dlon"), "h.dlat")).select(*(at(F.col(c) + s * F.col(f"h.{k}")).alias(n) for n, c, k, s in (("x0", "lon", "dlon", -1), ("x1", "lon", "dlon", 1), ("y0", "lat", "dlat", -1), ("y1", "lat", "dlat", 1))))
    return box.select(F.explode(F.sequence("y0", "y1")).alias("cy"), "x0", "x1")


def joined(runs: DataFrame) -> DataFrame:
    """``cy, x0, x1, area``: runs that touch along cells' sides are one area, named by the packed number of its least run."""
    own = runs.select("cy", "x0", "x1", (F.shiftleft((F.col("cy") + (1 << 30)).cast("bigint"), 32) + (F.col("x0") + (1 << 30))).alias("k"))
    spread = own.withColumn("_b", F.explode(F.sequence(F.floor(F.col("x0") / BLOCK), F.floor(F.col("x1") / BLOCK))))
    above = spread.select((F.col("cy") - 1).alias("cy"), "_b", F.col("x0").alias("y0"), F.col("x1").alias("y1"), F.col("k").alias("k2"))
    edges = spread.join(above, ["cy", "_b"]).where("x0 <= y1 AND y0 <= x1").select("k", "k2")
    named = components(edges, "k", "k2")
    return own.join(named, own.k == named.node, "left").select("cy", "x0", "x1", F.coalesce("component", "k").alias("area"))


def small_holes(solid: DataFrame, hole_m: float, cell_m: float) -> DataFrame:
    """``cy, x0, x1``: the gaps of all holes under ``hole_m`` squared.

    A gap that is larger in itself is of no such hole. What else a gap may meet in the rows next to it is told by the
    spans between such large gaps: a gap within a span on either side leads to solid cells and other small gaps only. A
    hole is an area of gaps that all do.
    """
    row = Window.partitionBy("cy").orderBy("x0")
    size = (F.col("x1") - F.col("x0") + 1) * cell_m * cell_m * shrinkage(cell_m)
    gap = solid.withColumn("_next", F.lead("x0").over(row)).select("cy", (F.col("x1") + 1).alias("x0"), (F.col("_next") - 1).alias("x1"))
    gap = stage(gap.where(F.col("x1").isNotNull() & (size < hole_m * hole_m)), "gaps")
    span = merged(solid.unionByName(gap))
    asked = gap.select(F.explode(F.array(F.col("cy") - 1, F.col("cy") + 1)).alias("cy"), "x0", "x1", F.struct("cy", "x0").alias("of"))
    both = span.withColumn("of", F.lit(None).cast(asked.schema["of"].dataType)).unionByName(asked).withColumn("_asks", F.col("of").isNotNull())
    latest = Window.partitionBy("cy").orderBy("x0", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    held = both.withColumn("_end", F.last(F.when(~F.col("_asks"), F.col("x1")), ignorenulls=True).over(latest)).where("_asks")
    shut = held.groupBy("of").agg(F.min(F.coalesce(F.col("_end") >= F.col("x1"), F.lit(False))).alias("shut")).select("of.*", "shut")
    area = stage(joined(gap).join(shut, ["cy", "x0"]), "holes")
    small = area.groupBy("area").agg(F.min("shut").alias("shut"), F.sum(size).alias("m2")).where(f"shut AND m2 < {hole_m * hole_m}")
    return area.join(small.select("area"), "area", "left_semi").select("cy", "x0", "x1")


def outlines(runs: DataFrame, cell_m: float) -> DataFrame:
    """``area, geom``: the outline of each area (``area, cy, x0, x1``) with its holes, outer rings against the clock.

    Sides of cells between inside and outside are joined up along rows and columns first, so the one group of an area's
    outline has its corners only.
    """
    d = cell_degrees(cell_m)
    line = runs.selectExpr("area", "explode(array(named_struct('cy', cy, 'side', 1), named_struct('cy', cy + 1, 'side', -1))) AS l", "x0", "x1").select("area", "l.*", "x0", "x1")
    # Eastwards below the inside, westwards above it.
    flat = sweep(line, "v", ("area", "cy"), "side").selectExpr("area", "IF(state > 0, x0, x1 + 1) AS ax", "cy AS ay", "IF(state > 0, x1 + 1, x0) AS bx", "cy AS by")
    edge = runs.selectExpr("area", "explode(array(named_struct('x', x0, 'up', false), named_struct('x', x1 + 1, 'up', true))) AS s", "cy").select("area", "s.*", "cy")
    column = Window.partitionBy("area", "x", "up").orderBy("cy")
    tall = edge.withColumn("_g", F.col("cy") - F.row_number().over(column)).groupBy("area", "x", "up", "_g").agg(F.min("cy").alias("lo"), (F.max("cy") + 1).alias("hi"))
    steep = tall.selectExpr("area", "x AS ax", "IF(up, lo, hi) AS ay", "x AS bx", "IF(up, hi, lo) AS by")

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        degrees = lambda ring: K.points_of([[(x * d, y * d) for x, y in ring]])[0]
        rings = trace(group[["ax", "ay", "bx", "by"]].to_numpy().astype(np.float64))
        geom = [{"outer": degrees(o), "holes": [degrees(h) for h in holes]} for o, holes in assemble(rings)]
        return pd.DataFrame({"area": [group["area"].iloc[0]], "geom": [geom]})

    return flat.unionByName(steep).groupBy("area").applyInPandas(chain, f"area bigint, geom array<struct<outer:{K.LINE},holes:array<{K.LINE}>>>")
