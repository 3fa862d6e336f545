"""Spatial joins: grid cells make the equi-join, exact geometry refines it.

A large shape is not cut into millions of small cells: every row picks the level
at which its envelope takes few cells (a cell of level k is 2^k times as wide),
and the other side is entered at each level that occurs. Levels are few. Shapes
are joined edge by edge: no polygon or line travels with its cells.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.functions import geo as G
from terrane.operators.entities import reach
from terrane.operators.shared import stage

#: A row takes about this many cells along each side at most.
ACROSS = 8
LEVELS = 12


def cell(c: Column, deg: Column | float) -> Column:
    return F.floor(c / deg).cast("bigint")


def cover(df: DataFrame, box: Column, deg: float) -> DataFrame:
    """``df`` with a row for each cell ``_level, _cx, _cy`` that the envelope meets, at the level that suits its size."""
    side = F.greatest(box["max_lon"] - box["min_lon"], box["max_lat"] - box["min_lat"])
    level = F.greatest(F.lit(0), F.least(F.lit(LEVELS - 1), F.ceil(F.log2(F.greatest(side, F.lit(1e-12)) / (deg * ACROSS))))).cast("int")
    sized = df.withColumn("_box", box).withColumn("_level", level).withColumn("_deg", deg * F.pow(F.lit(2.0), F.col("_level")))
    wide = sized.withColumn("_cx", F.explode(F.sequence(cell(F.col("_box.min_lon"), F.col("_deg")), cell(F.col("_box.max_lon"), F.col("_deg")))))
    tall = wide.withColumn("_cy", F.explode(F.sequence(cell(F.col("_box.min_lat"), F.col("_deg")), cell(F.col("_box.max_lat"), F.col("_deg")))))
    return tall.drop("_box", "_deg")


#: The finest cell of the polygon index, in degrees; a cell of level k is 2^k times as wide. Levels go by twos, so few occur.
FINEST, TOP = 0.25 / 1024, 22
CELL = ["_level", "_cx", "_cy"]


def _level_of(size: str, across: str) -> str:
    """SQL: the least even level at which ``size`` degrees take ``across`` cells at most."""
    return f"cast(2 * greatest(0, least({TOP // 2}, ceil(log2(greatest({size}, 1e-12) / ({FINEST} * {across})) / 2))) AS int)"


def _at_levels(df: DataFrame, levels: DataFrame, x: str, y: str) -> DataFrame:
    """``df`` with a row for the cell of each level that occurs; ``levels`` are a dozen rows at most."""
    every = df.withColumn("_level", F.expr(f"explode(sequence(0, {TOP}, 2))")).join(F.broadcast(levels), "_level", "left_semi")
    return every.selectExpr("*", f"cast(floor({x} / ({FINEST} * pow(2, _level))) AS bigint) AS _cx", f"cast(floor({y} / ({FINEST} * pow(2, _level))) AS bigint) AS _cy")


def polygon_edges(polygons: DataFrame) -> DataFrame:
    """``poly_id, part, e, ax, ay, bx, by`` of all rings, and ``_level, deg`` of the part's cells and its envelope ``x0, y0, x1, y1``."""
    parts = polygons.selectExpr("id AS poly_id", "posexplode(geom) AS (part, g)").selectExpr(
        "poly_id", "part", "concat(array(g.outer), coalesce(g.holes, slice(array(g.outer), 1, 0))) AS rings", *(f"{f}(transform(g.outer, p -> p.{c})) AS {n}" for f, c, n in (("array_min", "lon", "x0"), ("array_min", "lat", "y0"), ("array_max", "lon", "x1"), ("array_max", "lat", "y1")))
    )
    # A shape of many edges takes more cells, so that each has few of them.
    across = "greatest(8, least(256, floor(sqrt(aggregate(rings, 0, (n, r) -> n + size(r))) / 2)))"
    sized = parts.withColumn("_level", F.expr(_level_of("greatest(x1 - x0, y1 - y0)", across))).withColumn("deg", F.expr(f"{FINEST} * pow(2, _level)"))
    ring = sized.where("size(rings) > 0").selectExpr("* EXCEPT (rings)", "posexplode(rings) AS (_r, ring)").where("size(ring) > 1")
    edge = ring.selectExpr("* EXCEPT (ring)", "posexplode(zip_with(slice(ring, 1, size(ring) - 1), slice(ring, 2, size(ring) - 1), (a, b) -> named_struct('a', a, 'b', b))) AS (_k, s)")
    return edge.selectExpr("poly_id", "part", "named_struct('r', _r, 'k', _k) AS e", "_level", "deg", "x0", "y0", "x1", "y1", "s.a.lon AS ax", "s.a.lat AS ay", "s.b.lon AS bx", "s.b.lat AS by")


def _entered(df: DataFrame, deg: str, margin: str) -> DataFrame:
    """Segments ``ax, ay, bx, by`` by pieces of at most a cell ``deg``, with the cells that a piece comes within ``margin`` degrees of; a cell may come twice."""
    n = f"greatest(1, cast(ceil(greatest(abs(bx - ax), abs(by - ay)) / {deg}) AS int))"
    piece = df.selectExpr("*", f"{n} AS _n").selectExpr("*", "explode(sequence(0, _n - 1)) AS _k")
    ends = piece.selectExpr("* EXCEPT (_n, _k)", *(f"{a} + ({b} - {a}) * {k} / _n AS {c}" for a, b, k, c in (("ax", "bx", "_k", "_x0"), ("ax", "bx", "(_k + 1)", "_x1"), ("ay", "by", "_k", "_y0"), ("ay", "by", "(_k + 1)", "_y1"))))
    span = lambda p, q: f"explode(sequence(cast(floor((least({p}, {q}) - {margin}) / {deg}) AS bigint), cast(floor((greatest({p}, {q}) + {margin}) / {deg}) AS bigint)))"
    return ends.selectExpr("*", f"{span('_x0', '_x1')} AS _cx").selectExpr("* EXCEPT (_x0, _x1)", f"{span('_y0', '_y1')} AS _cy").drop("_y0", "_y1")


def polygon_index(polygons: DataFrame) -> DataFrame:
    """Cells of polygons: ``_level, _cx, _cy, poly_id, part, odd, e, ax, ay, bx, by, line``.

    A full cell is one row without an edge and with ``odd`` 1; cells outside have none. A partial cell has a row for
    each edge near it. Whether a point is inside is the parity of the edges that its ray to the east crosses: those
    within the cell, and those beyond the cell's east side. The latter parity is, at the point's latitude, that of the
    edges which cross the line of that side above: ``odd`` counts those above the cell, and ``line`` marks the edges
    that cross it in or near the cell, which are asked at the point's own latitude. So no polygon is sent anywhere.
    """
    edge = stage(polygon_edges(polygons), "edges")
    near = "deg * 1e-6"
    crossing = "ay + (by - ay) * (_east - ax) / (bx - ax)"
    # The highest row that lies below a crossing for certain.
    row = f"CASE WHEN _y > floor(_y / deg) * deg + {near} THEN floor(_y / deg) - 1 ELSE floor(_y / deg) - 2 END"
    listed = _entered(edge.drop("x0", "y0", "x1", "y1"), "deg", f"2 * {near}").distinct().selectExpr("*", "(_cx + 1) * deg AS _east")
    listed = listed.selectExpr("*", f"CASE WHEN (ax < _east) <> (bx < _east) THEN {crossing} END AS _y")
    listed = listed.selectExpr("poly_id", "part", "_cx", "_cy", "e", "ax", "ay", "bx", "by", f"coalesce(_cy > {row} AND _y >= _cy * deg - {near}, false) AS line")
    columns = edge.selectExpr("*", "explode(sequence(cast(floor(least(ax, bx) / deg) AS bigint) - 1, cast(floor(greatest(ax, bx) / deg) AS bigint))) AS _cx").selectExpr("*", "(_cx + 1) * deg AS _east")
    events = columns.where("(ax < _east) <> (bx < _east)").selectExpr("*", f"{crossing} AS _y").selectExpr("poly_id", "part", "_cx", f"cast({row} AS bigint) AS _cy", "1 AS n", "cast(null AS int) AS _level")
    box = edge.select("poly_id", "part", "_level", "deg", "x0", "y0", "x1", "y1").distinct()
    grid = box.selectExpr("*", "explode(sequence(cast(floor(x0 / deg) AS bigint), cast(floor(x1 / deg) AS bigint))) AS _cx").selectExpr("poly_id", "part", "_cx", "explode(sequence(cast(floor(y0 / deg) AS bigint), cast(floor(y1 / deg) AS bigint))) AS _cy", "0 AS n", "_level")
    # A column of one polygon is a window: its cells and the edges that cross its east side.
    above = Window.partitionBy("poly_id", "part", "_cx").orderBy(F.desc("_cy")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cells = grid.unionByName(events).withColumn("odd", (F.sum("n").over(above) % 2).cast("int")).where("_level IS NOT NULL").drop("n")
    return cells.join(listed, ["poly_id", "part", "_cx", "_cy"], "left").where("odd = 1 OR e IS NOT NULL")


#: SQL: whether an edge counts for a point: crossed within the cell, and, if it is marked, beyond the cell's east side.
_SPANS = "(ay > lat) <> (by > lat)"
_AT = "(bx - ax) * (lat - ay) / (by - ay) + ax"
_EAST = f"((_cx + 1) * ({FINEST} * pow(2, _level)))"
_COUNTS = f"""CASE WHEN e IS NULL THEN 0 ELSE
 cast(CASE WHEN {_SPANS} THEN lon < {_AT} AND {_AT} < {_EAST} ELSE false END AS int)
 ^ CASE WHEN line THEN cast(CASE WHEN {_SPANS} THEN {_AT} >= {_EAST} ELSE false END AS int) ^ cast(CASE WHEN ax >= {_EAST} THEN ay > lat ELSE by > lat END AS int) ELSE 0 END END"""


def shapes_of(polygons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct shapes ``id, geom`` of polygons, each under its least id, and ``poly_id, _of``: each polygon's shape.

    Many polygons may have one shape, as cities with one boundary have: it meets points and lines once.
    """
    own = stage(polygons.groupBy("geom").agg(F.min("id").alias("id")), "shapes").select("id", "geom")
    of = polygons.select(F.col("id").alias("poly_id"), "geom").join(own.withColumnRenamed("id", "_of"), "geom").select("poly_id", "_of")
    return own, stage(of, "shape-of")


def points_in_polygons(points: DataFrame, polygons: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``id, poly_id``: points (``id, lon, lat``, ids are unique) in polygons (``id, geom``): in any part, and in none of its holes.

    Lower and left edges belong to a polygon, upper and right ones do not. A written :func:`polygon_index` of the
    polygons can be given, to be made once for many uses.
    """
    index = stage(polygon_index(polygons), "polygon-index") if index is None else index
    left = _at_levels(points.select("id", "lon", "lat"), index.select("_level").distinct(), "lon", "lat")
    counted = left.join(index, CELL).selectExpr("id", "poly_id", "part", "odd", f"{_COUNTS} AS n")
    parity = counted.groupBy("id", "poly_id", "part").agg(F.bit_xor("n").alias("n"), F.max("odd").alias("odd"))
    return parity.where("(n ^ odd) = 1").select("id", "poly_id").distinct()


def in_coverage(df: DataFrame, *coverages: DataFrame) -> DataFrame:
    """Rows (``id, lon, lat``, the centroid) that lie in a polygon of every coverage."""
    for c in coverages:
        df = df.join(points_in_polygons(df, c).select("id").distinct(), "id", "left_semi")
    return df


def points_outside(points: DataFrame, polygons: DataFrame) -> DataFrame:
    return points.join(points_in_polygons(points, polygons).select("id").distinct(), "id", "left_anti")


def lines_in_shapes(lines: DataFrame, shapes: tuple[DataFrame, DataFrame], index: DataFrame) -> DataFrame:
    """As :func:`lines_in_polygons`, by :func:`shapes_of` polygons and the index of the distinct shapes."""
    own, of = shapes
    return lines_in_polygons(lines, own, index).withColumnRenamed("poly_id", "_of").join(of, "_of").select("id", "poly_id")


def points_in_shapes(points: DataFrame, shapes: tuple[DataFrame, DataFrame], index: DataFrame) -> DataFrame:
    """As :func:`points_in_polygons`, by :func:`shapes_of` polygons and the index of the distinct shapes."""
    own, of = shapes
    return points_in_polygons(points, own, index).withColumnRenamed("poly_id", "_of").join(of, "_of").select("id", "poly_id")


def lines_in_polygons(lines: DataFrame, polygons: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``id, poly_id``: lines (``id, coords``) that meet polygons: a vertex inside, or a segment that meets an edge.

    Vertices are points of the polygon index. Segments and edges meet by cells: each at the level that suits its length,
    and at the coarser levels of the other side. What is shuffled is single segments and edges.
    """
    vertex = lines.selectExpr("id", "posexplode(coords) AS (n, p)").selectExpr("named_struct('id', id, 'n', n) AS id", "p.lon AS lon", "p.lat AS lat")
    inside = points_in_polygons(vertex, polygons, index).select("id.id", "poly_id")
    cut = lines.where("size(coords) > 1").selectExpr("id", "explode(zip_with(slice(coords, 1, size(coords) - 1), slice(coords, 2, size(coords) - 1), (a, b) -> named_struct('a', a, 'b', b))) AS s")
    level = _level_of("greatest(abs(bx - ax), abs(by - ay))", "4")
    ends = ("s.a.lon AS ax", "s.a.lat AS ay", "s.b.lon AS bx", "s.b.lat AS by")
    left = cut.selectExpr("id", *ends).selectExpr("*", f"{level} AS _own")
    right = polygon_edges(polygons).selectExpr("poly_id", "ax", "ay", "bx", "by").selectExpr("*", f"{level} AS _own")
    # What is on one side of all polygons goes before anything is entered in cells; the envelope is one row.
    side = (("min(least(ax, bx)) - 1e-6", "_w"), ("max(greatest(ax, bx)) + 1e-6", "_e"), ("min(least(ay, by)) - 1e-6", "_s"), ("max(greatest(ay, by)) + 1e-6", "_n"))
    around = right.agg(*(F.expr(e).alias(n) for e, n in side))
    left = left.join(F.broadcast(around), F.expr("greatest(ax, bx) >= _w AND least(ax, bx) <= _e AND greatest(ay, by) >= _s AND least(ay, by) <= _n")).drop("_w", "_e", "_s", "_n")
    levels = left.select("_own").distinct().union(right.select("_own").distinct()).distinct().select(F.col("_own").alias("_level"))  # a dozen rows at most

    def enter(df: DataFrame) -> DataFrame:
        up = df.selectExpr("*", f"explode(sequence(_own, {TOP}, 2)) AS _level").join(F.broadcast(levels), "_level", "left_semi")
        wide = up.selectExpr("*", f"{FINEST} * pow(2, _level) AS _deg")
        return _entered(wide, "_deg", "_deg * 1e-6").drop("_deg").distinct()

    a = enter(left)
    b = enter(right).selectExpr("poly_id", "_own AS _own2", "_level", "_cx", "_cy", *(f"{c} AS {c}2" for c in ("ax", "ay", "bx", "by")))
    side = lambda p, q, r: f"signum(({q[0]} - {p[0]}) * ({r[1]} - {p[1]}) - ({q[1]} - {p[1]}) * ({r[0]} - {p[0]}))"
    s0, s1, e0, e1 = ("ax", "ay"), ("bx", "by"), ("ax2", "ay2"), ("bx2", "by2")
    meets = f"{side(s0, s1, e0)} <> {side(s0, s1, e1)} AND {side(e0, e1, s0)} <> {side(e0, e1, s1)}"
    crossing = a.join(b, CELL).where("_level = greatest(_own, _own2)").where(meets).select("id", "poly_id")
    return inside.union(crossing).distinct()


def candidates(left: DataFrame, right: DataFrame, radii_m: list[float], min_n: int) -> DataFrame:
    """``id, cand_id, level``: right points in the square round each left point, the square grown until it holds ``min_n``.

    Only the envelope is tested. Squares are grown by spots (see :func:`candidate_spots`); the points at them are put in
    last, so what is written and counted on the way does not grow with the pairs.
    """
    spots = candidate_spots(left, right, radii_m, min_n)
    near = spots.join(left.select("id", "lon", "lat"), ["lon", "lat"]).select("id", "x", "y", "level")
    return near.join(right.selectExpr("id AS cand_id", "lon AS x", "lat AS y"), ["x", "y"]).select("id", "cand_id", "level")


def candidate_spots(left: DataFrame, right: DataFrame, radii_m: list[float], min_n: int) -> DataFrame:
    """``lon, lat, x, y, level``: the distinct places of right points in the square round each distinct place of left points.

    A square has as many points as lie at its places. Each round has the places only that have not found enough yet; the
    last has what it finds. A cell is as wide as the round's square, so a square meets few cells.
    """
    spot = ["lon", "lat"]
    open_ = stage(left.select(*spot).distinct(), "open-points")
    other = stage(right.groupBy(F.col("lon").alias("x"), F.col("lat").alias("y")).agg(F.count(F.lit(1)).alias("n")), "spots")
    found = []
    for k, m in enumerate(radii_m):
        deg = 2 * m * 180 / (G.PLAIN_RADIUS * 3.141592653589793)
        turn = f"degrees({float(m)} / {G.EARTH_RADIUS})"
        a = open_.selectExpr(*spot, f"lon - {turn} / cos(radians(lat)) AS x0", f"lat - {turn} AS y0", f"lon + {turn} / cos(radians(lat)) AS x1", f"lat + {turn} AS y1")
        span = lambda p, q: f"explode(sequence(cast(floor({p} / {deg}) AS bigint), cast(floor({q} / {deg}) AS bigint)))"  # noqa: E731, B023
        a = a.selectExpr("*", f"{span('x0', 'x1')} AS _cx").selectExpr("*", f"{span('y0', 'y1')} AS _cy")
        b = other.selectExpr("*", f"cast(floor(x / {deg}) AS bigint) AS _cx", f"cast(floor(y / {deg}) AS bigint) AS _cy")
        hit = stage(a.join(b, ["_cx", "_cy"]).where("x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1").selectExpr(*spot, "x", "y", "n", f"{k} AS level"), "candidates")
        if k + 1 == len(radii_m):
            found.append(hit)
            break
        enough = hit.groupBy(*spot).agg(F.sum("n").alias("n")).where(F.col("n") >= min_n).select(*spot)
        found.append(hit.join(enough, spot, "left_semi"))
        open_ = stage(open_.join(enough, spot, "left_anti"), "open-points")
        if open_.isEmpty():
            break
    return reduce(DataFrame.union, found).drop("n")


def nearest_candidate(points: DataFrame, cities: DataFrame, radii_m: list[float], min_n: int) -> DataFrame:
    """``id, city_id, dist_m``: of each point's :func:`candidates` the nearest, ties by id.

    Cities at one place are as near as each other, so the least id stands for them; points at one place have one answer.
    """
    first = cities.groupBy(F.col("lon").alias("x"), F.col("lat").alias("y")).agg(F.min("id").alias("city_id"))
    near = candidate_spots(points, cities, radii_m, min_n).join(first, ["x", "y"]).withColumn("dist_m", G.haversine_m(F.col("lon"), F.col("lat"), F.col("x"), F.col("y")))
    best = near.groupBy("lon", "lat").agg(F.min(F.struct("dist_m", "city_id")).alias("m"))
    return points.select("id", "lon", "lat").join(best, ["lon", "lat"]).select("id", "m.city_id", "m.dist_m")


def nearest_segment(points: DataFrame, segments: DataFrame, max_m: float) -> DataFrame:
    """``id, line_id, dist_m``: of the lines within ``max_m`` metres the nearest, of equal ones (to a micrometre) the one with the least id."""
    radii = [m for m in (25.0, 75.0, 200.0, 400.0) if m < max_m / 2]
    return nearest_line(points, segments, [*radii, max_m])


def nearest_line(points: DataFrame, segments: DataFrame, radii_m: list[float], keys: tuple[str, ...] = (), limit: str | None = None) -> DataFrame:
    """``id, line_id, dist_m``: the nearest line within the last radius, or within the point's own ``limit`` in metres.

    The square round the points grows from radius to radius, and only points that have found nothing yet go on: what is
    within a radius is nearer than all that is beyond it. Lines are of the point's ``keys``, which both sides have.
    """
    open_ = points.select("id", "lon", "lat", *keys, *([F.col(limit).alias("_limit")] if limit else []))
    found, before = [], 0.0
    for k, radius in enumerate(radii_m):
        if limit:
            open_ = open_.where(F.col("_limit") > before)
        hits = near_segments(open_, segments, radius, keys)
        best = hits.groupBy("id").agg(F.min(F.struct(F.round("dist_m", 6).alias("dist_m"), "line_id")).alias("m"))
        found.append(stage(best.select("id", F.col("m.line_id").alias("line_id"), F.col("m.dist_m").alias("dist_m")), "nearest"))
        if k + 1 < len(radii_m):
            open_ = stage(open_.join(found[-1].select("id"), "id", "left_anti"), "open-points")
            if open_.isEmpty():
                break
        before = radius
    out = reduce(DataFrame.union, found)
    if limit:
        out = out.join(points.select("id", F.col(limit).alias("_limit")), "id").where(F.col("dist_m") <= F.col("_limit")).drop("_limit")
    return out


def _pieces(segments: DataFrame, deg: float, max_m: float, rows: DataFrame | None = None) -> DataFrame:
    """``segments`` by pieces of at most a cell, with a row for each cell ``_cx, _cy`` that a piece comes within ``max_m`` metres of.

    A slanting segment's envelope would take cells far from it; its pieces do not. ``_f`` and ``_t`` are where the piece
    begins and ends along its segment; a segment that has them already is divided between them. With ``rows`` (``_cy``)
    only pieces in these rows are entered, before their columns: near a pole a piece has very many.
    """
    if "_f" not in segments.columns:
        segments = segments.selectExpr("*", "0D AS _f", "1D AS _t")
    keep = [c for c in segments.columns if c not in ("_f", "_t")]
    parts = segments.selectExpr("*", f"greatest(1, cast(ceil((_t - _f) * greatest(abs(bx - ax), abs(by - ay)) / {deg}) AS int)) AS _n").selectExpr("*", "explode(sequence(0, _n - 1)) AS _k")
    parts = parts.selectExpr(*keep, "_f + (_t - _f) / _n * _k AS _f", "_f + (_t - _f) / _n * (_k + 1) AS _t")
    parts = parts.selectExpr("*", "ax + (bx - ax) * _f AS _x0", "ax + (bx - ax) * _t AS _x1", "ay + (by - ay) * _f AS _y0", "ay + (by - ay) * _t AS _y1")
    # A little more than asked, as cells are left by rounding too. The margin is that of the end further from the equator.
    turn = f"degrees({max_m * 1.05 + 0.01} / {G.EARTH_RADIUS})"
    span = lambda p, q, by: f"explode(sequence(cast(floor((least({p}, {q}) - {by}) / {deg}) AS bigint), cast(floor((greatest({p}, {q}) + {by}) / {deg}) AS bigint)))"
    tall = parts.selectExpr("*", f"{span('_y0', '_y1', turn)} AS _cy")
    if rows is not None:
        tall = tall.join(rows, "_cy", "left_semi")
    narrow = "cos(radians(greatest(abs(_y0), abs(_y1))))"
    # From a pole all longitudes are near.
    margin = f"CASE WHEN {narrow} * 180 > {turn} THEN {turn} / {narrow} ELSE 180D END"
    return tall.selectExpr(*keep, "_f", "_t", f"{span('_x0', '_x1', margin)} AS _cx", "_cy")


def segments_round(points: DataFrame, segments: DataFrame, max_m: float, deg: float) -> DataFrame:
    """Pieces of segments by cell, as :func:`_pieces` gives them, without what is in no coarse cell with a point.

    What is north or south of all points goes first, then what is in no row with a point.
    """
    coarse = 16 * deg
    held = points.selectExpr(f"cast(floor(lon / {coarse}) AS bigint) AS _cx", f"cast(floor(lat / {coarse}) AS bigint) AS _cy").distinct()
    turn = f"degrees({max_m * 1.05 + 0.01} / {G.EARTH_RADIUS})"
    reach = points.selectExpr("lat").agg(F.min("lat").alias("_s"), F.max("lat").alias("_n")).selectExpr(f"_s - {turn} AS _s", f"_n + {turn} AS _n")
    # One row, so the join is a filter.
    close = segments.join(F.broadcast(reach), F.expr("greatest(ay, by) >= _s AND least(ay, by) <= _n")).drop("_s", "_n")
    some = _pieces(close, coarse, max_m, held.select("_cy").distinct()).join(held, ["_cx", "_cy"], "left_semi").drop("_cx", "_cy").distinct()
    fine = points.selectExpr(f"cast(floor(lat / {deg}) AS bigint) AS _cy").distinct()
    return _pieces(some, deg, max_m, fine).drop("_f", "_t")


def near_segments(points: DataFrame, segments: DataFrame, max_m: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """``id, *keys, line_id, dist_m`` of all segments within ``max_m`` metres of a point, and at times some of them twice.

    ``segments`` has ``line_id, ax, ay, bx, by`` and the ``keys``, which a pair agrees in. Points are entered in their own
    cell, so a pair meets once a piece; the least of each point is a sum over rows.
    """
    deg = 4 * max_m * 180 / (G.PLAIN_RADIUS * 3.141592653589793)
    left = points.selectExpr("id", "lon", "lat", *keys, f"cast(floor(lon / {deg}) AS bigint) AS _cx", f"cast(floor(lat / {deg}) AS bigint) AS _cy")
    right = segments_round(points, segments.select("line_id", "ax", "ay", "bx", "by", *keys), max_m, deg)
    met = left.join(right, ["_cx", "_cy", *keys]).selectExpr("*", "(bx - ax) * (bx - ax) + (by - ay) * (by - ay) AS _s")
    met = met.selectExpr("*", "CASE WHEN _s = 0 THEN 0D ELSE greatest(0D, least(1D, ((lon - ax) * (bx - ax) + (lat - ay) * (by - ay)) / _s)) END AS _p").selectExpr("*", "ax + _p * (bx - ax) AS _x", "ay + _p * (by - ay) AS _y")
    sine = "pow(sin(radians(_y - lat) / 2), 2) + cos(radians(lat)) * cos(radians(_y)) * pow(sin(radians(_x - lon) / 2), 2)"
    return met.selectExpr("id", *keys, "line_id", f"2 * {G.EARTH_RADIUS} * asin(sqrt({sine})) AS dist_m").where(F.col("dist_m") <= max_m)


def line_segments(way_points: DataFrame) -> DataFrame:
    """``line_id, ax, ay, bx, by`` of resolved way points ``way_id, seq, lon, lat``."""
    after = Window.partitionBy("way_id").orderBy("seq")
    both = way_points.select("way_id", F.col("lon").alias("ax"), F.col("lat").alias("ay"), F.lead("lon").over(after).alias("bx"), F.lead("lat").over(after).alias("by"))
    return both.where("bx IS NOT NULL").withColumnRenamed("way_id", "line_id")


def nearest_city(points: DataFrame, pairs: DataFrame, cities: DataFrame) -> DataFrame:
    """``id, city_id, dist_m``: of each point's candidate cities the nearest, ties by id."""
    c = cities.select(F.col("id").alias("city_id"), F.col("lon").alias("cx"), F.col("lat").alias("cy"))
    near = pairs.join(points.select("id", "lon", "lat"), "id").join(c, "city_id").withColumn("dist_m", G.haversine_m(F.col("lon"), F.col("lat"), F.col("cx"), F.col("cy")))
    return near.groupBy("id").agg(F.min(F.struct("dist_m", "city_id")).alias("m")).select("id", "m.city_id", "m.dist_m")


def extract_regions(node: DataFrame, way_node: DataFrame, member: DataFrame, polygons: DataFrame, strategy: str = "simple", full: DataFrame | None = None) -> dict[str, DataFrame]:
    """Which entities belong to which region: tables ``node``, ``way``, ``relation`` of ``region_id, id``.

    simple: nodes inside, ways with such a node, relations with such a member. complete_ways: also all nodes of those
    ways, and parent relations. smart: also the node and way members, with the ways' nodes, of those relations; of
    those among ``full`` (``id``) only, if that is given.
    """
    nodes = points_in_polygons(node, polygons).select(F.col("poly_id").alias("region_id"), "id")
    nodes = stage(nodes, "nodes-inside")
    ways = stage(way_node.join(nodes.select("region_id", F.col("id").alias("ref")), "ref").select("region_id", F.col("way_id").alias("id")).distinct(), "ways-inside")

    def all_nodes(of: DataFrame) -> DataFrame:
        return way_node.join(of.select("region_id", F.col("id").alias("way_id")), "way_id").select("region_id", F.col("ref").alias("id"))

    if strategy != "simple":
        nodes = stage(nodes.union(all_nodes(ways)).distinct(), "nodes-of-ways")
    held = lambda kind, ids: member.where(F.col("type") == kind).join(ids.select("region_id", F.col("id").alias("ref")), "ref").select("region_id", F.col("rel_id").alias("id"))
    relations = held("way", ways).union(held("node", nodes)).distinct()
    if strategy != "simple":
        # From what was met upwards: a parent is entered once a region, whatever number of its children is in it.
        up = member.where("type = 'relation'").select(F.col("ref").alias("_from"), F.col("rel_id").alias("_to"))
        relations = reach(relations, up, "region_id")
    if strategy == "smart":
        whole = relations if full is None else relations.join(full.select("id"), "id", "left_semi").select("region_id", "id")
        more = stage(member.join(whole.withColumnRenamed("id", "rel_id"), "rel_id").where("type <> 'relation'").select("region_id", "type", F.col("ref").alias("id")).distinct(), "more-members")
        # Only ways that were not there before bring further nodes.
        new = stage(more.where("type = 'way'").select("region_id", "id").join(ways, ["region_id", "id"], "left_anti"), "more-ways")
        ways = ways.union(new)
        nodes = nodes.union(more.where("type = 'node'").select("region_id", "id")).union(all_nodes(new)).distinct()
    return {"node": nodes, "way": ways, "relation": relations}
