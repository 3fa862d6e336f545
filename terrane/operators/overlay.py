"""Union of polygons as joins over their edges.

Edges of one key are cut where they meet others of it, cell by cell; a piece is on
the outline if the union lies on one side of it only, which the polygon index
tells; the outline's pieces are chained into rings. Work follows the edges and
their crossings; what comes together in one group is the outline of one result.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions import geo as G
from terrane.operators import kernels as K
from terrane.operators.entities import with_seq
from terrane.operators.shared import stage
from terrane.operators.spatial import FINEST, TOP, _entered, _level_of, points_in_polygons, polygon_edges, polygon_index

#: Degrees (a tenth of a millimetre): corners are rounded to this, and sides are asked this far from an edge.
GRAIN = 1e-9


def union_polygons(polygons: DataFrame, key: str) -> DataFrame:
    """``key, geom``: the union of all polygons (``key, geom``) of each key, with holes, as parts that do not overlap.

    Corners are rounded to a tenth of a millimetre; slivers thinner than that may go. Outer rings run against the clock,
    holes with it. A key whose polygons have no area has no row.
    """
    parts = polygons.select(F.col(key).alias("_key"), F.explode("geom").alias("p")).where("size(p.outer) > 3")
    grain = lambda r: f"transform({r}, q -> named_struct('lon', round(q.lon, 9), 'lat', round(q.lat, 9)))"
    parts = parts.selectExpr("_key", f"array(named_struct('outer', {grain('p.outer')}, 'holes', transform(coalesce(p.holes, slice(array(p.outer), 1, 0)), h -> {grain('h')}))) AS geom")
    parts = stage(with_seq(parts.withColumn("_o", F.xxhash64("geom")), ["_key", "_o"], 0, "id").drop("_o"), "parts")
    edge = polygon_edges(parts).where("ax <> bx OR ay <> by").selectExpr("poly_id", "e", "ax", "ay", "bx", "by").join(parts.selectExpr("id AS poly_id", "_key"), "poly_id")
    # An edge that two polygons share counts once, whatever its direction.
    edge = _once(edge, [])
    edge = stage(with_seq(edge, ["_key", "ax", "ay", "bx", "by"], 0, "id"), "union-edges")
    piece = stage(_cut(edge), "union-pieces")
    inside = _sides(piece, parts)
    rings = piece.join(inside, "id").where("left_in <> right_in")
    # The union is to the left of every piece.
    rings = rings.selectExpr("_key", *(f"CASE WHEN left_in THEN {a} ELSE {b} END AS {a}" for a, b in (("ax", "bx"), ("ay", "by"), ("bx", "ax"), ("by", "ay"))))
    return _chained(rings, dict(parts.dtypes)["_key"]).withColumnRenamed("_key", key)


def _chained(edges: DataFrame, kind: str) -> DataFrame:
    """``_key, geom``: the polygons of directed edges with the area to their left."""

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        geom = [{"outer": K.points_of([o])[0], "holes": K.points_of(h)} for o, h in assemble(trace(group[["ax", "ay", "bx", "by"]].to_numpy()))]
        return pd.DataFrame({"_key": [group["_key"].iloc[0]], "geom": [geom]}) if geom else pd.DataFrame({"_key": group["_key"].iloc[:0], "geom": pd.Series([], dtype=object)})

    return edges.groupBy("_key").applyInPandas(chain, f"_key {kind}, geom array<struct<outer:{K.LINE},holes:array<{K.LINE}>>>")


def repair_polygons(polygons: DataFrame, key: str) -> DataFrame:
    """``key, geom, n_cuts``: polygons (``key, geom``) whose rings no longer cross themselves or each other.

    Rings are cut where they cross; inside is what the outer ring winds round, in either direction, and no hole does.
    Parts are mended one by one, and a part may become several; one without area goes, and so does a key without parts.
    ``n_cuts`` is the number of pieces that crossings added. Repeated points and open rings are mended on the way.
    Corners are rounded to a tenth of a millimetre. Winding numbers of the pieces are sums over joins by bands, of which
    a part has as many as the root of its pieces.
    """
    ring = polygons.select(F.col(key).alias("_id"), F.posexplode("geom").alias("_part", "p"))
    hole = "transform(coalesce(p.holes, slice(array(p.outer), 1, 0)), h -> named_struct('r', h, 'o', 0, 'h', 1))"
    ring = ring.selectExpr("struct(_id, _part) AS _key", f"explode(concat(array(named_struct('r', p.outer, 'o', 1, 'h', 0)), {hole})) AS s").select("_key", "s.*")
    ring = ring.withColumn("r", G.close_ring(F.col("r"))).selectExpr("_key", "transform(r, q -> named_struct('lon', round(q.lon, 9), 'lat', round(q.lat, 9))) AS r", "o", "h")
    edge = ring.select("_key", "o", "h", F.explode(G.segments(F.col("r"))).alias("s")).selectExpr("_key", "o", "h", "s.a.lon AS ax", "s.a.lat AS ay", "s.b.lon AS bx", "s.b.lat AS by")
    edge = stage(with_seq(_once(edge.where("ax <> bx OR ay <> by"), ["o", "h"]), ["_key", "ax", "ay", "bx", "by"], 0, "id"), "repair-edges")
    piece = stage(_cut(edge, ["o", "h"]), "repair-pieces")
    n = piece.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min(F.least("ax", "bx")).alias("_x0"), F.max(F.greatest("ax", "bx")).alias("_x1"), F.min(F.least("ay", "by")).alias("_y0"), F.max(F.greatest("ay", "by")).alias("_y1"))
    known = piece.join(n, "_key").selectExpr("*", "abs(by - ay) >= abs(bx - ax) AS steep", "greatest(1L, CAST(sqrt(_n) AS BIGINT)) AS _bands")
    sides = _winding(known, "y").unionByName(_winding(known, "x"))
    at = lambda s: f"({s}_o <> 0 AND {s}_h = 0)"
    whole = piece.drop("o", "h").join(sides, "id").selectExpr("*", f"{at('l')} AS left_in", f"{at('r')} AS right_in").where("left_in <> right_in")
    whole = whole.selectExpr("_key", *(f"CASE WHEN left_in THEN {a} ELSE {b} END AS {a}" for a, b in (("ax", "bx"), ("ay", "by"), ("bx", "ax"), ("by", "ay"))))
    shaped = _chained(whole, dict(edge.dtypes)["_key"])
    cuts = n.select("_key", "_n").join(edge.groupBy("_key").agg(F.count(F.lit(1)).alias("_e")), "_key").selectExpr("_key", "_n - _e AS n_cuts")
    out = shaped.join(cuts, "_key").groupBy(F.col("_key._id").alias(key)).agg(F.array_sort(F.collect_list(F.struct("_key._part", "geom"))).alias("g"), F.sum("n_cuts").alias("n_cuts"))
    return out.select(key, F.flatten(F.transform("g", lambda x: x["geom"])).alias("geom"), "n_cuts")


def _once(edges: DataFrame, nets: list[str]) -> DataFrame:
    """Each edge of a key once, from its lesser end; ``nets`` are how often it was passed in that direction over the other."""
    turned = "ax > bx OR (ax = bx AND ay > by)"
    ends = [f"CASE WHEN {turned} THEN {b} ELSE {a} END AS {a}" for a, b in (("ax", "bx"), ("ay", "by"), ("bx", "ax"), ("by", "ay"))]
    return edges.selectExpr("_key", *ends, *(f"CASE WHEN {turned} THEN -{c} ELSE {c} END AS {c}" for c in nets)).groupBy("_key", "ax", "ay", "bx", "by").agg(F.count(F.lit(1)).alias("_times"), *(F.sum(c).alias(c) for c in nets)).drop("_times")


def _winding(known: DataFrame, axis: str) -> DataFrame:
    """``id, l_o, r_o, l_h, r_h``: how often outer rings and holes wind round what is left and right of a piece.

    Steep pieces ask along a line to the east (``axis`` y), flat ones along a line to the north (x): the signed sum of
    the pieces that it crosses is the number on its own side, and the piece itself makes the other.
    """
    other = "x" if axis == "y" else "y"
    asking = known.where("steep" if axis == "y" else "NOT steep").selectExpr("_key", "id", "o", "h", "ax", "ay", "bx", "by", "(ax + bx) / 2 AS mx", "(ay + by) / 2 AS my", "_bands", "_x0", "_x1", "_y0", "_y1")
    band = lambda v: f"CAST(floor(({v} - _{axis}0) / greatest(_{axis}1 - _{axis}0, 1e-9D) * _bands) AS BIGINT)"
    asking = asking.selectExpr("*", f"{band(f'm{axis}')} AS _b").drop("_bands", "_x0", "_x1", "_y0", "_y1")
    met = known.where(f"a{axis} <> b{axis}").selectExpr("_key", "id AS id2", "o AS o2", "h AS h2", "ax AS cx", "ay AS cy", "bx AS dx", "by AS dy", f"explode(sequence({band(f'least(a{axis}, b{axis})')}, {band(f'greatest(a{axis}, b{axis})')})) AS _b")
    p, q = (f"c{axis}", f"d{axis}"), (f"c{other}", f"d{other}")
    cross = f"({p[0]} > m{axis}) <> ({p[1]} > m{axis}) AND id <> id2 AND {q[0]} + ({q[1]} - {q[0]}) * (m{axis} - {p[0]}) / ({p[1]} - {p[0]}) > m{other}"
    # Up counts once for the line to the east, west once for the line to the north.
    sign = "IF(dy > cy, 1, -1)" if axis == "y" else "IF(dx > cx, -1, 1)"
    sums = asking.join(met, ["_key", "_b"]).where(cross).groupBy("id").agg(*(F.sum(F.expr(f"{sign} * {c}2")).alias(f"_{c}") for c in "oh"))
    near = asking.select("id", "o", "h", "ay", "by").join(sums, "id", "left").selectExpr("id", "ay", "by", "o", "h", "coalesce(_o, 0) AS _o", "coalesce(_h, 0) AS _h")
    if axis == "y":  # the sum is that of the east, which is right of a piece that goes up
        west = lambda c: f"_{c} + IF(by > ay, {c}, -{c})"
        return near.selectExpr("id", *(f"IF(by > ay, {west(c)}, _{c}) AS l_{c}" for c in "oh"), *(f"IF(by > ay, _{c}, {west(c)}) AS r_{c}" for c in "oh"))
    return near.selectExpr("id", *(f"_{c} AS l_{c}" for c in "oh"), *(f"_{c} - {c} AS r_{c}" for c in "oh"))


def _cut(edge: DataFrame, nets: list[str] = []) -> DataFrame:  # noqa: B006
    """``id, _key, ax, ay, bx, by``: the pieces of edges between the places where they meet others of their key; sums of ``nets``."""
    level = _level_of("greatest(bx - ax, abs(by - ay))", "4")
    own = edge.selectExpr("*", f"{level} AS _own")
    levels = own.select(F.col("_own").alias("_level")).distinct()  # a dozen rows at most
    up = own.selectExpr("*", f"explode(sequence(_own, {TOP}, 2)) AS _level").join(F.broadcast(levels), "_level", "left_semi").selectExpr("*", f"{FINEST} * pow(2, _level) AS _deg")
    a = _entered(up, "_deg", "_deg * 1e-6").drop("_deg").distinct()
    other = a.selectExpr("_key", "_level", "_cx", "_cy", "id AS id2", "_own AS _own2", "ax AS cx", "ay AS cy", "bx AS dx", "by AS dy")
    # Each pair is met once in a cell, the lower id first, so that both get the very same point.
    met = a.join(other, ["_key", "_level", "_cx", "_cy"]).where("id < id2 AND _level = greatest(_own, _own2)").select("id", "id2", "ax", "ay", "bx", "by", "cx", "cy", "dx", "dy").distinct()
    met = met.selectExpr("*", "(bx - ax) * (dy - cy) - (by - ay) * (dx - cx) AS _d").selectExpr("*", "CASE WHEN _d <> 0 THEN ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / _d END AS _t", "CASE WHEN _d <> 0 THEN ((cx - ax) * (by - ay) - (cy - ay) * (bx - ax)) / _d END AS _u")
    on = lambda x, y, a=("ax", "ay", "bx", "by"): (
        f"(abs(({a[2]} - {a[0]}) * ({y} - {a[1]}) - ({a[3]} - {a[1]}) * ({x} - {a[0]})) <= {GRAIN} * greatest(abs({a[2]} - {a[0]}), abs({a[3]} - {a[1]}))"
        f" AND {x} BETWEEN least({a[0]}, {a[2]}) - {GRAIN} AND greatest({a[0]}, {a[2]}) + {GRAIN} AND {y} BETWEEN least({a[1]}, {a[3]}) - {GRAIN} AND greatest({a[1]}, {a[3]}) + {GRAIN})"
    )
    second = ("cx", "cy", "dx", "dy")
    spot = lambda i, x, y: f"named_struct('id', {i}, 'x', {x}, 'y', {y})"
    at = [f"CASE WHEN {on(x, y)} THEN {spot('id', x, y)} END" for x, y in (("cx", "cy"), ("dx", "dy"))] + [f"CASE WHEN {on(x, y, second)} THEN {spot('id2', x, y)} END" for x, y in (("ax", "ay"), ("bx", "by"))]
    # A crossing that is a corner of either edge is that corner, found above.
    corner = " OR ".join([on("cx", "cy"), on("dx", "dy"), on("ax", "ay", second), on("bx", "by", second)])
    x, y = "round(ax + _t * (bx - ax), 9)", "round(ay + _t * (by - ay), 9)"
    cross = f"_t BETWEEN 0 AND 1 AND _u BETWEEN 0 AND 1 AND NOT ({corner})"
    at += [f"CASE WHEN {cross} THEN {spot(i, x, y)} END" for i in ("id", "id2")]
    cuts = met.selectExpr(f"explode(array_compact(array({', '.join(at)}))) AS c").select("c.*")
    ends = edge.selectExpr("id", "explode(array(named_struct('x', ax, 'y', ay), named_struct('x', bx, 'y', by))) AS p").select("id", "p.*")
    listed = cuts.unionByName(ends).groupBy("id").agg(F.collect_set(F.struct("x", "y")).alias("ps")).join(edge, "id")
    order = "((p.x - ax) * (bx - ax) + (p.y - ay) * (by - ay))"
    sorted_ = listed.selectExpr("_key", *nets, f"array_sort(transform(ps, p -> named_struct('t', {order}, 'x', p.x, 'y', p.y))) AS ps")
    pair = "zip_with(slice(ps, 1, size(ps) - 1), slice(ps, 2, size(ps) - 1), (a, b) -> named_struct('ax', a.x, 'ay', a.y, 'bx', b.x, 'by', b.y))"
    pieces = sorted_.selectExpr("_key", *nets, f"explode({pair}) AS s").select("_key", *nets, "s.*").where("ax <> bx OR ay <> by")
    once = _once(pieces, nets)
    return with_seq(once, ["_key", "ax", "ay", "bx", "by"], 0, "id")


def _sides(piece: DataFrame, parts: DataFrame) -> DataFrame:
    """``id, left_in, right_in``: whether any polygon of the key holds what is next to the middle of a piece, to each side."""
    size = "sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay))"
    off = f"{GRAIN} / 2 / {size}"
    side = lambda k, s: f"named_struct('k', {k}, 'x', (ax + bx) / 2 - {s} * (by - ay) * {off}, 'y', (ay + by) / 2 + {s} * (bx - ax) * {off})"
    asked = stage(piece.selectExpr("_key", "id", f"explode(array({side(0, 1)}, {side(1, -1)})) AS s").selectExpr("_key AS _own", "id * 2 + s.k AS id", "s.x AS lon", "s.y AS lat"), "union-sides")
    held = points_in_polygons(asked, parts, stage(polygon_index(parts), "polygon-index")).join(parts.selectExpr("id AS poly_id", "_key"), "poly_id")
    held = held.join(asked.select("id", "_own"), "id").where("_key = _own").select("id").distinct()
    each = held.selectExpr("id div 2 AS id", "id % 2 AS k").groupBy("id").agg(F.max(F.expr("k = 0")).alias("l"), F.max(F.expr("k = 1")).alias("r"))
    return piece.select("id").join(each, "id", "left").selectExpr("id", "coalesce(l, false) AS left_in", "coalesce(r, false) AS right_in")


def trace(edges: np.ndarray) -> list[K.Pairs]:
    """Closed rings of directed edges with the area to their left. Where rings touch in a corner, they stay apart."""
    out: dict[tuple[float, float], list[tuple[float, float]]] = defaultdict(list)
    for ax, ay, bx, by in sorted(map(tuple, edges.tolist())):
        out[ax, ay].append((bx, by))
    rings = []
    for start in list(out):
        while out[start]:
            ring = [start, out[start].pop()]
            while ring[-1] != start and out.get(ring[-1]):
                (px, py), (x, y) = ring[-2], ring[-1]
                back = math.atan2(py - y, px - x)
                turn = lambda q, back=back, x=x, y=y: (back - math.atan2(q[1] - y, q[0] - x)) % (2 * math.pi) or 2 * math.pi
                after = min(out[ring[-1]], key=turn)
                out[ring[-1]].remove(after)
                ring.append(after)
            if ring[-1] == start and len(ring) > 3:
                rings.append(ring)
    return rings


def area(ring: K.Pairs) -> float:
    """Positive against the clock."""
    x0, y0 = ring[0]
    return sum((ax - x0) * (by - y0) - (bx - x0) * (ay - y0) for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False)) / 2


def assemble(rings: list[K.Pairs]) -> list[tuple[K.Pairs, list[K.Pairs]]]:
    """Outer rings with their holes: a hole lies in the smallest outer ring round it."""
    outers = sorted((r for r in rings if area(r) > 0), key=area)
    holes: dict[int, list[K.Pairs]] = defaultdict(list)
    for r in rings:
        if area(r) < 0:
            # A point just inside the area, next to the hole's first edge, as a corner may touch the outer ring.
            (ax, ay), (bx, by) = r[0], r[1]
            size = math.hypot(bx - ax, by - ay)
            spot = ((ax + bx) / 2 - (by - ay) / size * GRAIN / 2, (ay + by) / 2 + (bx - ax) / size * GRAIN / 2)
            home = next((i for i, o in enumerate(outers) if K.inside(spot, o)), None)
            if home is not None:
                holes[home].append(r)
    return sorted((o, sorted(holes[i])) for i, o in enumerate(outers))
