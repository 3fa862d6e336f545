"""Residential areas against a plain grid, at several latitudes."""

import math
from collections import Counter

import numpy as np
import pytest

from terrane.operators import areas as A
from terrane.operators import kernels as K
from terrane.operators import runs as R
from terrane.operators.entities import Entities
from terrane.plans import jobs
from terrane.schema import NODE, POLYGON, RELATION, WAY

CELL = 20.0
D = R.cell_degrees(CELL)


def fill(cells):
    """Components of a set of cells that touch along sides."""
    left, out = set(cells), []
    while left:
        todo, got = [left.pop()], set()
        while todo:
            x, y = todo.pop()
            got.add((x, y))
            for c in ((x - 1, y), (x + 1, y), (x, y - 1), (x, y + 1)):
                if c in left:
                    left.remove(c)
                    todo.append(c)
        out.append(got)
    return out


def plain(land, cell_m, gap_m, least_m, hole_m, d):
    """The areas of polygons as sets of cells, cell by cell."""
    narrow = lambda y: math.cos(math.radians((y + 0.5) * d))
    cells = set()
    for outer, holes in land:
        xs, ys = [p[0] for p in outer], [p[1] for p in outer]
        for x in range(math.floor(min(xs) / d) - 1, math.floor(max(xs) / d) + 2):
            for y in range(math.floor(min(ys) / d) - 1, math.floor(max(ys) / d) + 2):
                c = ((x + 0.5) * d, (y + 0.5) * d)
                if K.inside(c, outer) and not any(K.inside(c, h) for h in holes):
                    cells.add((x, y))
    up = max(1, round(gap_m / cell_m / 2))
    side = lambda y: max(1, math.floor(gap_m / cell_m / 2 / narrow(y) + 0.5))
    grown = {(x + i, y + j) for x, y in cells for i in range(-side(y), side(y) + 1) for j in range(-up, up + 1)}
    low = {(x, y) for x, y in grown if all((x, y + j) in grown for j in range(-up, up + 1))}
    solid = {(x, y) for x, y in low if all((x + i, y) in low for i in range(-side(y), side(y) + 1))}
    assert cells <= solid
    x0, x1, y0, y1 = (f(c[i] for c in solid) + s for i in (0, 1) for f, s in ((min, -1), (max, 1)))
    m2 = lambda part: sum(cell_m * cell_m * narrow(y) for _, y in part)
    for part in fill({(x, y) for x in range(x0, x1 + 1) for y in range(y0, y1 + 1)} - solid):
        if (x0, y0) not in part and m2(part) < hole_m * hole_m:
            solid |= part
    return [a for a in fill(solid) if m2(a) > least_m * least_m]


def cells_of(runs):
    out = {}
    for r in runs.collect():
        out.setdefault(r.area, set()).update((x, r.cy) for x in range(r.x0, r.x1 + 1))
    return out


def shoelace(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False)) / 2


@pytest.mark.parametrize("lat", [0.0, 50.0, -65.0])
def test_areas_are_those_of_a_plain_grid(spark, lat):
    rng = np.random.default_rng(int(lat) + 100)
    narrow = math.cos(math.radians(lat))
    land = []
    for _ in range(30):
        w, s = rng.uniform(0, 90, 2).tolist()
        a, b, slant = *rng.uniform(1, 16, 2).tolist(), float(rng.uniform(-3, 3))
        at = lambda x, y: (14.0 + x * D / narrow, lat + y * D)
        outer = [at(w, s), at(w + a, s + slant), at(w + a + slant, s + b + slant), at(w - slant, s + b), at(w, s)]
        land.append((outer, [[at(w + a * f, s + b * g) for f, g in ((0.3, 0.3), (0.7, 0.3), (0.7, 0.7), (0.3, 0.7), (0.3, 0.3))]] if a > 8 and b > 8 else []))
    land.append(([at(x, y) for x, y in ((100, 0), (130, 2), (128, 30), (99, 28), (100, 0))], [[at(x, y) for x, y in ((105, 6), (120, 8), (119, 20), (105, 6))]]))
    options = dict(gap_m=60.0, least_m=90.0, hole_m=120.0)
    df = spark.createDataFrame([(i, [p]) for i, p in enumerate(land)], f"id long, geom array<{POLYGON}>")
    areas, runs = A.residential_areas(df, spark.createDataFrame([], "id long, lon double, lat double"), CELL, **options)
    want = plain(land, CELL, d=D, **options)
    got = cells_of(runs)
    assert len(want) > 1 and {frozenset(c) for c in got.values()} == {frozenset(c) for c in want}
    assert {r.area: r.n_cells for r in areas.collect()} == {k: len(c) for k, c in got.items()}
    d = D
    shapes = {r.area: r.geom for r in R.outlines(runs, CELL).collect()}
    assert shapes.keys() == got.keys() and any(len(p.holes) for g in shapes.values() for p in g)
    for area, geom in shapes.items():
        rings = [[(round(c.lon / d), round(c.lat / d)) for c in r] for p in geom for r in (p.outer, *p.holes)]
        assert all(r[0] == r[-1] for r in rings) and sum(map(shoelace, rings)) == len(got[area])
        assert all((a[0] == b[0]) != (a[1] == b[1]) and (b[0] == c[0]) != (a[0] == b[0]) for r in rings for a, b, c in zip(r, r[1:], r[2:], strict=False))
        # Every cell's middle is in the polygon.
        for x, y in list(got[area])[:50]:
            assert sum(K.inside((x + 0.5, y + 0.5), r) for r in rings) % 2 == 1


def test_class_depends_on_metres_at_any_latitude(spark):
    found = {}
    for lat in (0.0, 50.0, 65.0):
        dy = R.cell_degrees(1.0)
        dx = dy / math.cos(math.radians(lat))
        box = lambda x, y, w, h, dx=dx, dy=dy, lat=lat: ([(14 + i * dx, lat + j * dy) for i, j in ((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))], [])
        # A city, a village, a plot too small, and two halves 20 m apart.
        land = [box(0, 0, 1600, 1600), box(3000, 0, 1300, 1300), box(5000, 0, 80, 80), box(6000, 0, 800, 1600), box(6820, 0, 800, 1600)]
        df = spark.createDataFrame([(i, [p]) for i, p in enumerate(land)], f"id long, geom array<{POLYGON}>")
        houses = spark.createDataFrame([(1, 14 + 3000 * dx, lat + 3000 * dy), (2, 14 + 3050 * dx, lat + 3000 * dy), (3, 14 + 9000 * dx, lat + 3000 * dy)], "id long, lon double, lat double")
        areas, _ = A.residential_areas(df, houses, 10.0, least_m=85.0)
        found[lat] = sorted((r["class"], r.area_m2) for r in areas.collect())
    kinds = [[k for k, _ in v] for v in found.values()]
    assert kinds == [["city", "city", "village", "village"]] * 3
    for v in found.values():
        for (_, a), (_, b) in zip(v, found[0.0], strict=True):
            assert a == pytest.approx(b, rel=0.15)


def test_holes_over_the_bound_and_open_ones_stay(spark):
    """Runs are given by hand: a shut hole, a hole open at a corner of rows, and none at all."""
    rows = ["#######", "#..#..#", "#..#..#", "####.##", "...#.##", "#######"]
    runs = [(y, x, x) for y, r in enumerate(rows) for x, c in enumerate(r) if c == "#"]
    solid = R.merged(spark.createDataFrame(runs, "cy long, x0 long, x1 long"))
    got = lambda hole: sorted((r.cy, r.x0, r.x1) for r in R.small_holes(solid, hole, 10.0).collect())
    assert got(100.0) == [(1, 1, 2), (1, 4, 5), (2, 1, 2), (2, 4, 5), (3, 4, 4), (4, 4, 4)]
    assert got(22.0) == [(1, 1, 2), (2, 1, 2)] and got(15.0) == []
    empty = solid.where("false")
    assert R.small_holes(empty, 100.0, 10.0).count() == 0 and R.outlines(empty.selectExpr("0L AS area", "*"), 10.0).count() == 0
    assert Counter(r.area for r in R.joined(solid).collect()).total() == solid.count()


def test_residential_job_gives_sorted_entities(spark):
    node = [(1, 14.0, 60.0, {}), (2, 14.04, 60.0, {}), (3, 14.04, 60.02, {}), (4, 14.0, 60.02, {}), (5, 14.1, 60.0, {}), (6, 14.1004, 60.0, {}), (7, 14.1004, 60.0002, {})]
    way = [(10, [1, 2, 3, 4, 1], {"landuse": "residential"}), (11, [5, 6, 7, 5], {"building": "yes"})]
    e = Entities(spark.createDataFrame(node, NODE), spark.createDataFrame(way, WAY), spark.createDataFrame([], RELATION))
    out = jobs.build_residential(e, least_m=50.0)
    ways = out["way"].collect()
    assert [w.id for w in ways] == sorted(w.id for w in ways) and sorted(w.tags["lm_landuse"] for w in ways) == ["residential_city", "residential_village"]
    ids = [r.id for r in out["node"].collect()]
    assert ids == sorted(ids) and {i for w in ways for i in w.refs} == set(ids) and out["relation"].count() == 0
