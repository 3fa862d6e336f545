"""Unions of polygons against plain counting."""

import random

import numpy as np
from test_spatial_index import inside_any, star

from terrane.operators import kernels as K
from terrane.operators.overlay import area, trace, union_polygons
from terrane.schema import POLYGON

ROWS = f"k string, geom array<{POLYGON}>"


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def united(spark, rows):
    geom = {}
    for r in union_polygons(spark.createDataFrame(rows, ROWS), "k").collect():
        geom[r.k] = [([(p.lon, p.lat) for p in g.outer], [[(p.lon, p.lat) for p in h] for h in g.holes]) for g in r.geom]
    return geom


def total(geom):
    return sum(area(o) + sum(area(h) for h in holes) for o, holes in geom)


def test_boxes_that_overlap_touch_share_and_repeat(spark):
    rows = [("cross", [(box(0, 1, 3, 2), [])]), ("cross", [(box(1, 0, 2, 3), [])])]
    rows += [("side", [(box(0, 0, 1, 1), [])]), ("side", [(box(1, 0, 2, 1), [])]), ("part of a side", [(box(0, 0, 1, 1), [])]), ("part of a side", [(box(1, 0.25, 2, 0.5), [])])]
    rows += [("corner", [(box(0, 0, 1, 1), [])]), ("corner", [(box(1, 1, 2, 2), [])]), ("within", [(box(0, 0, 3, 3), []), (box(1, 1, 2, 2), [])]), ("same", [(box(0, 0, 1, 1), [])]), ("same", [(box(0, 0, 1, 1), [])])]
    rows += [("ring", [(box(0, 0, 3, 1), [])]), ("ring", [(box(0, 2, 3, 3), [])]), ("ring", [(box(0, 0, 1, 3), [])]), ("ring", [(box(2, 0, 3, 3), [])])]
    rows += [("plug", [(box(0, 0, 3, 3), [box(1, 1, 2, 2)])]), ("plug", [(box(1, 1, 2, 1.5), [])]), ("apart", [(box(0, 0, 1, 1), [])]), ("apart", [(box(5, 5, 6, 6), [])])]
    rows += [("turned", [(box(0, 0, 2, 2)[::-1], [])]), ("turned", [(box(1, 1, 3, 3), [])]), ("none", []), ("none", None), ("flat", [([(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (0.0, 0.0)], [])])]
    rows = [(k, g and [([(float(x), float(y)) for x, y in o], [[(float(x), float(y)) for x, y in h] for h in hs]) for o, hs in g]) for k, g in rows]
    got = united(spark, rows)
    want = {"cross": (5, 1, 0), "side": (2, 1, 0), "part of a side": (1.25, 1, 0), "corner": (2, 2, 0), "within": (9, 1, 0), "same": (1, 1, 0), "ring": (8, 1, 1), "plug": (8.5, 1, 1), "apart": (2, 2, 0), "turned": (7, 1, 0)}
    assert {k: (round(total(g), 9), len(g), sum(len(h) for _, h in g)) for k, g in got.items()} == want


def test_random_shapes_by_membership_and_area(spark):
    rnd = random.Random(4)
    rows = [(str(k), [(star(rnd, 14 + rnd.random(), 50 + rnd.random(), rnd.choice([0.1, 0.4]), rnd.randrange(3, 30)), [])]) for k in range(4) for _ in range(12)]
    got = united(spark, rows)
    gen = np.random.default_rng(5)
    for k, geom in got.items():
        own = [g for key, g in rows if key == k]
        pts = list(zip((13.5 + 2 * gen.random(2500)).tolist(), (49.5 + 2 * gen.random(2500)).tolist(), strict=True))
        hit = [any(inside_any(p, g) for g in own) for p in pts]
        assert hit == [inside_any(p, geom) for p in pts]
        # In no two parts at once: the sum of areas is that of the union.
        assert max(sum(K.inside(p, o) and not any(K.inside(p, h) for h in hs) for o, hs in geom) for p in pts) <= 1
        assert abs(total(geom) - 4 * sum(hit) / len(pts)) < 0.15


def test_rings_that_touch_stay_apart():
    edges = [(*a, *b) for ring in (box(0, 0, 1, 1), box(1, 1, 2, 2)) for a, b in zip(ring, ring[1:], strict=False)]
    assert sorted(area(r) for r in trace(np.array(edges, float))) == [1.0, 1.0]


def test_empty_table(spark):
    assert union_polygons(spark.createDataFrame([], ROWS), "k").count() == 0
