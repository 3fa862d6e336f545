"""Tile covers against a plain test of every tile."""

import math

import numpy as np

from terrane.operators import kernels as K
from terrane.operators import tiles as TI
from terrane.schema import POLYGON


def lat_of(y, z):
    return math.degrees(math.atan(math.sinh(math.pi - 2 * math.pi * y / (1 << z))))


def meets(parts, x, y, z):
    w, e, n, s = x / (1 << z) * 360 - 180, (x + 1) / (1 << z) * 360 - 180, lat_of(y, z), lat_of(y + 1, z)
    for outer, holes in parts:
        for r in (outer, *holes):
            for (ax, ay), (bx, by) in zip(r, r[1:], strict=False):
                side = [(bx - ax) * (q - ay) - (by - ay) * (p - ax) for p in (w, e) for q in (n, s)]
                if min(ax, bx) <= e and max(ax, bx) >= w and min(ay, by) <= n and max(ay, by) >= s and min(side) <= 0 <= max(side):
                    return True
        if K.inside((w, n), outer) and not any(K.inside((w, n), h) for h in holes):
            return True
    return False


def test_cover_is_that_of_a_plain_test(spark):
    rng = np.random.default_rng(3)
    shapes = []
    for _ in range(12):
        cx, cy, r = *rng.uniform(-150, 150, 1).tolist(), *rng.uniform(-75, 75, 1).tolist(), float(rng.uniform(0.5, 25))
        turn = lambda f, k: [(cx + f * r * math.cos(2 * math.pi * i / k) * float(rng.uniform(0.6, 1)), max(-84.0, min(84.0, cy + f * r * math.sin(2 * math.pi * i / k)))) for i in range(k)]
        outer, hole = turn(1, 9), turn(0.45, 5)
        shapes.append([(outer + outer[:1], [hole + hole[:1]])])
    shapes.append([([(0.0, 0.0), (45.0, 0.0), (45.0, 20.0), (0.0, 0.0)], [])])  # corners on sides of tiles
    shapes.append([([(-170.0, -89.0), (-160.0, -89.0), (-160.0, 89.0), (-170.0, 89.0), (-170.0, -89.0)], [])])  # beyond the rows of tiles
    df = spark.createDataFrame(list(enumerate(shapes)), f"id long, geom array<{POLYGON}>")
    got = {}
    for r in TI.tile_cover(df, 6).collect():
        got.setdefault((r.id, r.z), set()).add((r.x, r.y))
    for i, parts in enumerate(shapes):
        for z in (3, 6):
            assert got[i, z] == {(x, y) for x in range(1 << z) for y in range(1 << z) if meets(parts, x, y, z)}, (i, z)
    assert {r for r in got if r[1] == 0} == {(i, 0) for i in range(len(shapes))}


def test_cover_sends_no_polygon_with_its_tiles(spark):
    ring = [(14 + math.cos(2 * math.pi * i / 50_000), 50 + math.sin(2 * math.pi * i / 50_000)) for i in range(50_000)]
    df = spark.createDataFrame([(1, [(ring + ring[:1], [])])], f"id long, geom array<{POLYGON}>")
    cover = TI.tile_cover(df, 10)
    plan = cover._jdf.queryExecution().executedPlan().toString()
    assert "geom" not in plan.split("Exchange")[0] and "Cartesian" not in plan and "NestedLoop" not in plan
    tiles = {(r.x, r.y) for r in cover.where("z = 10").collect()}
    spots = {(math.floor((x + 180) / 360 * 1024), math.floor((1 - math.asinh(math.tan(math.radians(y))) / math.pi) / 2 * 1024)) for x, y in [*ring, (14.0, 50.0), (14.5, 50.5)]}
    assert spots <= tiles and len(tiles) < 60
    assert TI.tile_cover(df.where("false"), 5).count() == 0
