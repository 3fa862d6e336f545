"""Cell indexes against plain loops: points and lines in polygons, nearest lines, growing squares, clusters and house links."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrane.functions import geo as G
from terrane.operators import kernels as K
from terrane.operators import spatial as S
from terrane.operators import streets as ST
from terrane.plans import jobs
from terrane.schema import LINE, POLYGON

GEOM = f"id long, geom array<{POLYGON}>"


def star(rnd, x, y, r, n):
    """A ring that does not cross itself, closed."""
    turns = sorted(rnd.random() * 2 * math.pi for _ in range(n))
    ring = [(x + r * (0.3 + 0.7 * rnd.random()) * math.cos(t), y + r * (0.3 + 0.7 * rnd.random()) * math.sin(t)) for t in turns]
    return [*ring, ring[0]]


def shapes(rnd):
    out = []
    for i in range(40):
        r = rnd.choice([0.001, 0.02, 0.3, 3.0])
        x, y = 14 + rnd.random(), 50 + rnd.random()
        parts = [(star(rnd, x, y, r, rnd.randrange(3, 40)), [star(rnd, x, y, r * 0.1, 5)] if rnd.random() < 0.5 else [])]
        if rnd.random() < 0.3:
            parts.append((star(rnd, x + r / 2, y, r, 6), []))  # parts may overlap
        out.append((i, parts))
    # Edges and corners on the lines of cells.
    for k, (w, s, e, n) in enumerate([(14.0, 50.0, 14.25, 50.25), (14.25, 50.25, 14.5, 50.5), (14.0, 50.125, 14.0625, 50.1875)]):
        box = [(w, s), (w, n), (e, n), (e, s), (w, s)]
        out.append((100 + k, [(box, [[(w + 0.015625, s + 0.015625), (e - 0.015625, s + 0.015625), (e - 0.015625, n - 0.015625), (w + 0.015625, s + 0.015625)]])]))
    return out


def inside_any(p, geom):
    return any(sum(K.inside(p, r) for r in (outer, *holes)) % 2 for outer, holes in geom)


def test_points_in_polygons_match_ray_casting(spark):
    rnd = random.Random(1)
    polys = shapes(rnd)
    pts = [(14 + rnd.random(), 50 + rnd.random()) for _ in range(400)]
    pts += [(13 + k / 64, 49.5 + j / 64) for k in range(64, 100) for j in range(30, 60)]  # on the lines of cells
    pts += [(p[0], p[1] + d) for _, geom in polys for outer, _ in geom for p in outer[:6] for d in (0, 1e-9)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "id long, lon double, lat double")
    got = {tuple(r) for r in S.points_in_polygons(points, spark.createDataFrame(polys, GEOM)).collect()}
    want = {(i, k) for i, p in enumerate(pts) for k, geom in polys if inside_any(p, geom)}
    assert got == want and len(want) > 1000


def test_a_shape_of_100_000_vertices(spark):
    n = 100_000
    t = np.linspace(0, 2 * math.pi, n, endpoint=False)
    r = 5 + 0.5 * np.sin(40 * t) + 0.01 * np.random.default_rng(3).random(n)
    ring = list(zip((14 + r * np.cos(t)).tolist(), (50 + r * np.sin(t)).tolist(), strict=True))
    ring.append(ring[0])
    poly = spark.createDataFrame([(1, [(ring, [])])], GEOM)
    rnd = np.random.default_rng(4)
    x, y = 8 + 12 * rnd.random(3000), 44 + 12 * rnd.random(3000)
    points = spark.createDataFrame(list(zip(range(3000), x.tolist(), y.tolist(), strict=True)), "id long, lon double, lat double")
    p = np.array(ring)
    a, b = p[:-1], p[1:]
    want = set()
    for i in range(3000):
        spans = (a[:, 1] > y[i]) != (b[:, 1] > y[i])
        s, e = a[spans], b[spans]
        if ((e[:, 0] - s[:, 0]) * (y[i] - s[:, 1]) / (e[:, 1] - s[:, 1]) + s[:, 0] > x[i]).sum() % 2:
            want.add(i)
    assert {r.id for r in S.points_in_polygons(points, poly).collect()} == want
    index = S.polygon_index(poly)
    per_cell = index.where("e IS NOT NULL").groupBy("_cx", "_cy").count().agg(F.max("count")).first()[0]
    assert per_cell < n / 50 and index.where("e IS NULL").count() > 100
    # No row holds a shape: all columns are numbers or an edge's number.
    assert not [c for c, kind in index.dtypes if kind.startswith("array")]


def test_empty_sides_give_no_rows(spark):
    points = spark.createDataFrame([], "id long, lon double, lat double")
    poly = spark.createDataFrame([(1, [([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)], [])]), (2, []), (3, None), (4, [([], [])])], GEOM)
    assert S.points_in_polygons(points, poly).count() == 0
    one = spark.createDataFrame([(1, 0.2, 0.5)], "id long, lon double, lat double")
    assert [tuple(r) for r in S.points_in_polygons(one, poly).collect()] == [(1, 1)]
    assert S.points_in_polygons(one, poly.where("false")).count() == 0


def test_lines_in_polygons_match_plain_loops(spark):
    rnd = random.Random(2)
    polys = shapes(rnd)
    lines = []
    for i in range(250):
        x, y, step = 14 + rnd.random(), 50 + rnd.random(), rnd.choice([0.0005, 0.01, 0.5])
        line = [(x, y)]
        for _ in range(rnd.randrange(0, 4)):
            line.append((line[-1][0] + step * (rnd.random() - 0.5), line[-1][1] + step * (rnd.random() - 0.5)))
        lines.append((i, line))
    got = {tuple(r) for r in S.lines_in_polygons(spark.createDataFrame(lines, f"id long, coords {LINE}"), spark.createDataFrame(polys, GEOM)).collect()}
    sign = lambda a, b, c: np.sign((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]))

    def meets(line, geom):
        if any(inside_any(p, geom) for p in line):
            return True
        rings = [r for outer, holes in geom for r in (outer, *holes)]
        return any(sign(a, b, c) != sign(a, b, d) and sign(c, d, a) != sign(c, d, b) for a, b in zip(line, line[1:], strict=False) for r in rings for c, d in zip(r, r[1:], strict=False))

    assert got == {(i, k) for i, line in lines for k, geom in polys if meets(line, geom)}


def segment_m(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    size = dx * dx + dy * dy
    t = max(0.0, min(1.0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / size)) if size else 0.0
    x, y = a[0] + t * dx, a[1] + t * dy
    h = math.sin(math.radians(y - p[1]) / 2) ** 2 + math.cos(math.radians(p[1])) * math.cos(math.radians(y)) * math.sin(math.radians(x - p[0]) / 2) ** 2
    return 2 * 6_372_800.0 * math.asin(math.sqrt(h))


def test_nearest_line_by_key_and_limit(spark):
    rnd = random.Random(5)
    pts = [(i, 14 + rnd.random() * 0.05, 50 + rnd.random() * 0.05, rnd.choice("abc"), rnd.choice([100.0, 400.0, 500.0])) for i in range(150)]
    segs = [(j, 14 + rnd.random() * 0.05, 50 + rnd.random() * 0.05, rnd.choice("abcd")) for j in range(60)]
    segs = [(j, x, y, x + (rnd.random() - 0.5) * rnd.choice([0.0, 0.004, 0.1]), y + (rnd.random() - 0.5) * 0.004, k) for j, x, y, k in segs]
    points = spark.createDataFrame(pts, "id long, lon double, lat double, key string, limit double")
    lines = spark.createDataFrame(segs, "line_id long, ax double, ay double, bx double, by double, key string")
    got = {r.id: (r.line_id, round(r.dist_m, 5)) for r in S.nearest_line(points, lines, [50.0, 200.0, 400.0, 500.0], ("key",), "limit").collect()}
    want = {}
    for i, x, y, k, limit in pts:
        near = [(round(segment_m((x, y), s[1:3], s[3:5]), 6), s[0]) for s in segs if s[5] == k]
        if near and min(near)[0] <= limit:
            want[i] = (min(near)[1], round(min(near)[0], 5))
    assert got == want and 20 < len(want) < 150


def test_growing_squares_carry_open_points_only(spark):
    rnd = random.Random(8)
    left = [(i, 14 + rnd.random() * 0.2, 50 + rnd.random() * 0.2) for i in range(60)] + [(99, 30.0, 10.0)]
    right = [(j, 14 + rnd.random() * 0.2, 50 + rnd.random() * 0.2) for j in range(80)]
    radii = [500.0, 1000.0, 2000.0, 4000.0]
    cols = "id long, lon double, lat double"
    got = {tuple(r) for r in S.candidates(spark.createDataFrame(left, cols), spark.createDataFrame(right, cols), radii, 4).collect()}
    want = set()
    for i, x, y in left:
        for k, m in enumerate(radii):
            turn = math.degrees(m / 6_372_800.0)
            hit = [j for j, a, b in right if abs(a - x) <= turn / math.cos(math.radians(y)) and abs(b - y) <= turn]
            if len(hit) >= 4 or k == 3:
                want |= {(i, j, k) for j in hit}
                break
    assert got == want


def test_clusters_grow_by_their_envelopes(spark):
    near = lambda x, y: [(x, y), (x + 0.001, y)]
    rows = [(1, 10, near(0.0, 0.0)), (1, 11, near(0.003, 0.0)), (1, 12, near(0.02, 0.0)), (2, 20, near(0.0, 0.0))]
    # 30 and 31 make an envelope that 32 is near to, though it is near to neither of them.
    rows += [(3, 30, [(0.0, 0.0), (0.01, 0.0)]), (3, 31, [(0.0, 0.0), (0.0, 0.01)]), (3, 32, near(0.009, 0.0095))]
    parts = spark.createDataFrame(rows, f"street_id long, part_id long, coords {LINE}")
    assert {tuple(r) for r in ST.split_clusters(parts).collect()} == {(10, 10), (11, 10), (12, 12), (20, 20), (30, 30), (31, 30), (32, 30)}
    rnd = np.random.default_rng(2)
    boxes = rnd.random((300, 2)) * 2
    boxes = np.hstack([boxes, boxes + rnd.random((300, 2)) * 0.05])
    label = K.grow_clusters(boxes, 0.02)
    env = {h: (*boxes[label == h][:, :2].min(0), *boxes[label == h][:, 2:].max(0)) for h in np.unique(label)}
    apart = lambda a, b: a[0] - b[2] > 0.02 or b[0] - a[2] > 0.02 or a[1] - b[3] > 0.02 or b[1] - a[3] > 0.02
    heads = list(env)
    assert all(apart(env[a], env[b]) for i, a in enumerate(heads) for b in heads[:i])


def test_long_lines_are_halved_until_short(spark):
    line = [(14.0 + k * 0.05, 50.0) for k in range(20)]
    out = ST.halve_long(spark.createDataFrame([(1, [line]), (2, [line[:2]])], f"id long, geom array<{LINE}>"), 20_000.0).collect()
    assert sorted((r.id, r.part) for r in out if r.id == 2) == [(2, "")]
    parts = [r for r in out if r.id == 1]
    length = lambda g: sum(math.dist((p.lon, p.lat), (q.lon, q.lat)) for ln in g for p, q in zip(ln, ln[1:], strict=False))
    assert len(parts) == 4 and abs(sum(length(r.geom) for r in parts) - 0.95) < 1e-9
    assert all(segment_m((14, 50), (14, 50), (14, 50)) == 0 and max(p.lon for ln in r.geom for p in ln) - min(p.lon for ln in r.geom for p in ln) < 0.25 for r in parts)


@pytest.mark.parametrize("seed", [1, 2])
def test_house_links_match_a_plain_version(spark, seed):
    rnd = random.Random(seed)
    names = ["Main Street", "Main Streat", "Oak Road", "Oak Rode", "Elm", "Élm", "Zürich Weg"]
    street = [(100 + j, rnd.choice(names), [[(x := 14 + rnd.random() * 0.03, y := 50 + rnd.random() * 0.03), (x + rnd.random() * 0.004, y + rnd.random() * 0.004)]]) for j in range(25)]
    house = []
    for i in range(120):
        kind = rnd.random()
        street_name = rnd.choice([*names, "main street", "Elms", "Nowhere"]) if kind < 0.6 else None
        place = rnd.choice(["Elm", "Oak Rd", "Town"]) if 0.6 <= kind < 0.8 else None
        house.append((i, i + 1000, str(i), street_name, place, None, 14 + rnd.random() * 0.03, 50 + rnd.random() * 0.03))
    town = [(1, 2, "Town", None, 100, 14.01, 50.01, {"de": "Stadt"}, None), (2, 3, "Village", None, 10, 14.02, 50.02, {"de": "Dorf"}, None)]
    places = spark.createDataFrame(town, f"id long, type_code int, name string, is_in string, population int, lon double, lat double, names map<string,string>, geom array<{POLYGON}>")
    houses = spark.createDataFrame(house, "row long, id long, number string, street_name string, place string, city string, lon double, lat double")
    streets = spark.createDataFrame(street, f"id long, name string, geom array<{LINE}>")
    got = {r["row"]: (r["street_id"], r["name_key"]) for r in jobs.link_houses(houses, streets, places).collect()}
    fold = lambda s: spark_norm[s]
    every = sorted({n for _, n, _ in street} | {h[3] or h[4] for h in house if h[3] or h[4]})
    from terrane.functions import tags as T

    spark_norm = {r.n: r.k for r in spark.createDataFrame([(n,) for n in every], "n string").select("n", F.lower(T.normalize_name(F.col("n"))).alias("k")).collect()}
    for row, _, _, street_name, place, _, x, y in house:
        near = [(round(min(segment_m((x, y), a, b) for ln in g for a, b in zip(ln, ln[1:], strict=False)), 6), sid, n) for sid, n, g in street]
        name = street_name or place
        if name:
            limit = 400.0 if street_name else 500.0
            same = [(d, s) for d, s, n in near if fold(n) == fold(name) and d <= limit]
            alike = [(-K.similarity(name, n), s) for d, s, n in near if d <= limit and K.similarity(name, n) > 0.9]
            want = (min(same)[1] if same else min(alike)[1] if alike else None, name)
        else:
            best = min((d, s) for d, s, _ in near)
            far = best[0] > 75.0
            towns = sorted((segment_m((x, y), (c[5], c[6]), (c[5], c[6])), c[2]) for c in town)
            want = (None, got[row][1]) if far else (best[1], None)
            assert not far or got[row][1] in {t for _, t in towns} | {None}
        assert got[row] == want, row
    assert sum(s is not None for s, _ in got.values()) > 20
