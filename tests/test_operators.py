import json
import math

import pytest
from pyspark.sql import functions as F

from terrane.functions import geo as G
from terrane.functions import tags as T
from terrane.functions import tiles as X
from terrane.operators import areas as A
from terrane.operators import entities as E
from terrane.operators import houses as H
from terrane.operators import kernels as K
from terrane.operators import places as P
from terrane.operators import poi as O
from terrane.operators import spatial as S
from terrane.operators import streets as ST
from terrane.operators import tiles as TI
from terrane.schema import NODE, POLYGON, RELATION, WAY
from terrane.sources import readers, writers
from terrane.streaming import jobs


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())] if values else [(1,)], list(values) or ["x"])
    return row.select(column.alias("v")).first().v


def square(x, y, size, holes=()):
    ring = lambda a, b, s: [(float(i), float(j)) for i, j in ((a, b), (a + s, b), (a + s, b + s), (a, b + s), (a, b))]
    return (ring(x, y, size), [ring(*h) for h in holes])


def tagmap(spark, rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id long, tags map<string,string>")


def flags(spark, rows, column):
    return [r.v for r in tagmap(spark, rows).select("id", column.alias("v")).orderBy("id").collect()]


t = lambda: F.col("tags")


def test_tag_filters(spark):
    rows = [{"highway": "track", "name": ""}, {"highway": "proposed"}, {"place": "Town"}, {"a": "associatedStreet"}, {}, {"building": "yes"}]
    assert flags(spark, rows, T.tags_match(t(), ["w/highway=track,path", "nr/building"], "w")) == [True, False, False, False, False, False]
    assert flags(spark, rows, T.tags_match(t(), ["nwr/highway=*"], "n")) == [True, True, False, False, False, False]
    assert flags(spark, rows, T.is_place(t())) == [False, False, True, False, False, False]
    assert flags(spark, rows, T.address_way(t())) == [True, False, True, True, True, True]
    assert flags(spark, rows, T.address_relation(t())) == [False, False, True, True, False, True]
    assert flags(spark, [{"place": "continent"}, {"admin_level": "4"}, {"border_type": "territorial"}, {"admin_level": "5"}], T.country_entity(t())) == [False, True, True, False]
    assert flags(spark, [{"landuse": "railway"}, {"landuse": "forest"}, {}], T.is_residential_landuse(t())) == [True, False, False]


def test_route_rules(spark):
    good = {"route": "hiking", "network": "lwn"}
    rows = [good, good | {"state": "proposed"}, good | {"disused": "yes"}, good | {"type": "network"}, {"route": "bus"}, good | {"type": "superroute"}, good | {"type": "superroute", "osmc:symbol": "red"}, {"route": "hiking", "type": "superroute", "osmc:symbol": "red", "network": "rcn"}]
    assert flags(spark, rows, T.is_tourist_route(t())) == [True, False, False, False, False, False, True, False]
    fixed = flags(spark, [{"route": "mtb"}, {"route": "foot", "network": "x"}, {"route": "ski", "network": "x"}, {"route": "bicycle", "network": "icn"}], T.fix_network(t()["route"], t()["network"]))
    assert fixed == ["lcn", "lwn", "x", "icn"]
    assert flags(spark, [{"rwn_ref": "1"}, {"rcn_ref": "2", "rwn_ref": "3"}], T.junction_tags(t())) == [{"rwn_ref": "1", "hiking_node": "NLBE"}, {"rcn_ref": "2", "rwn_ref": "3", "cycle_node": "NLBE", "hiking_node": "NLBE"}]
    parsed = flags(spark, [{"s": "red:white:red_bar:E8:black"}, {"s": "green"}, {"s": "teal"}, {"s": ""}, {"s": "Blue:x:y:longer_text"}], T.parse_osmc(t()["s"]))
    assert parsed[0] == {"osmc": "yes", "osmc_color": "red", "osmc_background": "white", "osmc_foreground": "red_bar", "osmc_text_length": "2", "osmc_text": "E8", "osmc_text_color": "black"}
    assert parsed[1:4] == [{"osmc": "yes", "osmc_color": "green"}, {"osmc": "yes"}, {}] and parsed[4] == {"osmc": "yes", "osmc_color": "Blue", "osmc_background": "x", "osmc_foreground": "y"}
    names = flags(spark, [{"n": "A", "r": "1"}, {"n": "A 1", "r": "1"}, {"n": "", "r": "1"}, {"n": "A", "r": ""}], T.merge_ref_name(t()["n"], t()["r"]))
    assert names == ["A, 1", "A 1", "1", "A"]


def test_way_tags_pass_on(spark):
    df = spark.createDataFrame([({"route": "foot", "layer": "2"}, {"highway": "path", "layer": "1", "surface": "mud"})], "r map<string,string>, w map<string,string>")
    assert df.select(T.inherit_way_tags(F.col("r"), F.col("w")).alias("v")).first().v == {"route": "foot", "layer": "2", "osmc_highway": "path", "lm_highway": "path"}


def test_names_and_numbers(spark):
    assert flags(spark, [{"name": "A", "name:de": "B", "name:fr": "A", "name:en": "", "name:old": "C"}], T.names_by_lang(t(), "name", t()["name"])) == [{"de": "B"}]
    assert one(spark, T.normalize_name(F.col("s")), s="  Žluťoučký  kůň-(x)  É ") == "Zlutoucky kun x E"
    assert flags(spark, [{"i": "a; b"}, {"i": "a"}, {}], T.is_in_list(t()["i"])) == [["a", "b"], [], []]
    assert flags(spark, [{"name": "", "addr:street": "S"}, {"street": "T"}, {}], T.street_name(t())) == ["S", "T", None]
    assert flags(spark, [{"admin_level": "8"}, {"admin_level": "x"}, {}], T.admin_level(t())) == [8, -1, -1]
    assert flags(spark, [{"k": "all"}, {"k": "odd"}, {"k": "alphabetic"}, {"k": "4"}, {"k": "x"}], T.interpolation_step(t()["k"])) == [1, 2, 1, 4, None]
    prio = spark.createDataFrame([(0, 5), (0, 6), (0, 12), (0, 25), (0, 30), (600_000, 30), (1_000_000, 0), (500_000, 0)], "p int, n int")
    assert [r.v for r in prio.select(T.city_priority(F.col("p"), F.col("n")).alias("v")).collect()] == [1, 1.75, 2, 1, 2.5, 2, 2.75, 1]
    levels = spark.createDataFrame([(x,) for x in (8, 7, 6, 9, 10, 4, -1, None)], "l int")
    assert [r.v for r in levels.select(T.level_priority(F.col("l")).alias("v")).collect()] == [1, 2, 3, 4, 5, 6, 5, 5]
    assert flags(spark, [{"Name": "A"}, {"name:EN": "B", "name": ""}, {}], T.poi_name(t())) == ["A", "B", None]
    similar = spark.createDataFrame([("Praha 1", "Praha"), ("Okres Brno", "Brno"), ("Brnox", "Brno"), ("Brno", "")], "a string, b string")
    assert [r.v for r in similar.select(T.similar_name(F.col("a"), F.lit(""), F.col("b"), ["x"]).alias("v")).collect()] == [True, True, True, False]
    assert one(spark, T.version_ms(F.lit("2024.02.01"))) == 1706745600000


def test_geometry_columns(spark):
    lon, lat = F.col("x"), F.col("y")
    assert one(spark, G.haversine_m(lon, lat, lon + 1, lat), x=14.0, y=50.0) == pytest.approx(2 * 6372800 * math.asin(math.cos(math.radians(50)) * math.sin(math.radians(0.5))), abs=1e-6)
    poly = spark.createDataFrame([(1, [square(0, 0, 10, [(2, 2, 3)])])], f"id long, geom array<{POLYGON}>")
    got = poly.select(*(G.in_geom(F.lit(a), F.lit(b), F.col("geom")).alias(f"c{i}") for i, (a, b) in enumerate([(1.0, 1.0), (3.0, 3.0), (11.0, 1.0), (9.9, 9.9)]))).first()
    assert tuple(got) == (True, False, False, True)
    text = poly.select(G.geom_to_geojson(F.col("geom")).alias("v"))
    assert json.loads(text.first().v)["coordinates"][0][1][0] == [2.0, 2.0]
    assert text.select(G.geom_from_geojson(F.col("v")).alias("v")).first().v == poly.first().geom
    assert poly.select(F.size(G.drop_holes(F.col("geom")[0], 1e12)["holes"]).alias("v")).first().v == 0
    assert one(spark, G.to_short(F.col("x").cast("int")), x=5) == 5
    with pytest.raises(Exception, match="not a short"):
        one(spark, G.to_short(F.col("x").cast("int")), x=40000)
    rect = one(spark, G.ring_area_m2(G.rectangle(lon, lat, F.lit(100.0))), x=14.0, y=50.0)
    assert rect == pytest.approx(40000, rel=1e-3)


def test_tile_numbers_round_trip(spark):
    for x, y, z in ((14.42, 50.09, 12), (-179.9, -84.0, 3), (0.0, 0.0, 0)):
        tx, ty = one(spark, X.tile_x(F.col("x"), z), x=x), one(spark, X.tile_y(F.col("y"), z), y=y)
        assert one(spark, X.tile_lon(F.col("x"), z), x=tx) <= x < one(spark, X.tile_lon(F.col("x") + 1, z), x=tx)
        assert one(spark, X.tile_lat(F.col("y") + 1, z), y=ty) <= y <= one(spark, X.tile_lat(F.col("y"), z), y=ty)


def entities(spark):
    node = spark.createDataFrame([(i, float(i), 0.0, {}) for i in range(1, 9)], NODE)
    way = spark.createDataFrame([(10, [1, 2, 99], {"highway": "path"}), (11, [3, 98], {}), (12, [4, 5, 4], {"x": "y"})], WAY)
    rel = spark.createDataFrame([(20, [("way", 10, "outer"), ("relation", 21, "")], {"a": "b"}), (21, [("relation", 20, ""), ("relation", 22, "")], {}), (22, [("way", 12, ""), ("node", 8, "")], {})], RELATION)
    return E.Entities(node, way, rel)


def test_resolving_and_closures(spark):
    e = entities(spark)
    lines = {r.id: [(p.lon, p.lat) for p in r.coords] for r in E.resolve_ways(E.way_nodes(e.way), e.node).collect()}
    assert lines == {10: [(1.0, 0.0), (2.0, 0.0)], 12: [(4.0, 0.0), (5.0, 0.0), (4.0, 0.0)]}
    got = {(r.root, r.rel_id, r.depth) for r in E.expand_relations(E.members(e.relation)).collect()}
    assert got == {(20, 20, 0), (20, 21, 1), (20, 22, 2), (21, 21, 0), (21, 20, 1), (21, 22, 1), (22, 22, 0)}
    full = E.tags_filter(e, ["r/a=b"])
    assert [sorted(r.id for r in df.collect()) for df in full] == [[1, 2, 4, 5, 8], [10, 12], [20, 21, 22]]
    assert E.contains_id(e.way, 12) and not E.contains_id(e.way, 1)


def test_changes_and_numbers(spark):
    rows = lambda *r: spark.createDataFrame([(x[0], x[1], x[2], x[3], None) for x in r], "type string, id long, version long, action string, ts timestamp")
    now = E.apply_changes(rows(("node", 1, 1, "create"), ("node", 2, 1, "create")), rows(("node", 1, 3, "delete"), ("node", 1, 2, "modify"), ("node", 3, 1, "create"), ("way", 2, 5, "modify")))
    assert sorted((r.type, r.id, r.version) for r in now.collect()) == [("node", 2, 1), ("node", 3, 1), ("way", 2, 5)]
    seq = E.with_seq(spark.range(1000).repartition(7), ["id"], 5)
    assert seq.where("seq <> id + 5").count() == 0 and seq.count() == 1000
    assert {r.value: r.id for r in E.dictionary(spark.createDataFrame([("b",), ("a",), ("",), ("b",)], "w string"), "w").collect()} == {"a": 1, "b": 2}


def test_large_and_small_polygons_in_one_join(spark):
    polys = spark.createDataFrame([(1, [square(0, 0, 40)]), (2, [square(10.0, 10.0, 0.01)]), (3, [square(-5, -5, 1), square(39, 39, 2)])], f"id long, geom array<{POLYGON}>")
    pts = spark.createDataFrame([(1, 10.005, 10.005), (2, 39.5, 39.5), (3, -4.5, -4.5), (4, 90.0, 0.0)], "id long, lon double, lat double")
    out = S.points_in_polygons(pts, polys)
    assert {tuple(r) for r in out.collect()} == {(1, 1), (1, 2), (2, 1), (2, 3), (3, 3)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
    lines = spark.createDataFrame([(1, [(-10.0, 5.0), (60.0, 5.0)]), (2, [(-4.9, -4.9), (-4.8, -4.8)]), (3, [(50.0, 0.0), (60.0, 0.0)])], "id long, coords array<struct<lon:double,lat:double>>")
    assert {tuple(r) for r in S.lines_in_polygons(lines, polys).collect()} == {(1, 1), (2, 3)}


def test_nearest_segment_matches_brute_force(spark):
    import random

    r = random.Random(4)
    seg = [(i, *(v for _ in range(2) for v in (14 + r.random() * 0.02, 50 + r.random() * 0.02))) for i in range(40)]
    pts = [(i, 14 + r.random() * 0.02, 50 + r.random() * 0.02) for i in range(60)]
    got = {x.id: x.line_id for x in S.nearest_segment(spark.createDataFrame(pts, "id long, lon double, lat double"), spark.createDataFrame(seg, "line_id long, ax double, ay double, bx double, by double"), 200.0).collect()}

    def dist(p, s):
        _, ax, ay, bx, by = s
        d = (bx - ax) ** 2 + (by - ay) ** 2
        k = max(0, min(1, ((p[1] - ax) * (bx - ax) + (p[2] - ay) * (by - ay)) / d))
        qx, qy = ax + k * (bx - ax), ay + k * (by - ay)
        a = math.sin(math.radians(qy - p[2]) / 2) ** 2 + math.cos(math.radians(p[2])) * math.cos(math.radians(qy)) * math.sin(math.radians(qx - p[1]) / 2) ** 2
        return 2 * 6372800 * math.asin(math.sqrt(a))

    want = {p[0]: min((dist(p, s), s[0]) for s in seg) for p in pts}
    assert got == {i: s for i, (m, s) in want.items() if m <= 200}


def test_streets(spark):
    ws = spark.createDataFrame([(1, "A"), (2, "A"), (3, "A"), (4, "A"), (5, "B")], "way_id long, name string")
    wc = spark.createDataFrame([(1, 7), (2, 7), (2, 8), (3, 8), (4, 9), (5, 7)], "way_id long, city_id long")
    assert {r.way_id: r.street_id for r in ST.join_streets(ws, wc).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    path = ST.street_table(ws.withColumn("is_path", F.col("way_id") == 3), ST.join_streets(ws, wc))
    assert {r.street_id: r.is_path for r in path.collect()} == {1: True, 4: False, 5: False}
    far = spark.createDataFrame([(1, 1, [(14.0, 50.0), (14.001, 50.0)]), (1, 2, [(14.002, 50.0), (14.003, 50.0)]), (1, 3, [(14.1, 50.0), (14.101, 50.0)])], "street_id long, part_id long, coords array<struct<lon:double,lat:double>>")
    assert {r.part_id: r.cluster for r in ST.split_clusters(far).collect()} == {1: 1, 2: 1, 3: 3}
    merged = ST.merge_lines(spark.createDataFrame([(1, [(0.0, 0.0), (1.0, 0.0)]), (1, [(2.0, 0.0), (1.0, 0.0)])], "street_id long, coords array<struct<lon:double,lat:double>>")).first()
    assert [len(x) for x in merged.geom] == [3]
    seg = spark.createDataFrame([(1, 0.1, 0.1, 0.4, 0.2)], "line_id long, ax double, ay double, bx double, by double")
    pieces = ST.split_grid(seg).orderBy("ax").collect()
    assert [(round(p.ax, 6), round(p.bx, 6), p.cx, p.cy) for p in pieces] == [(0.1, 0.15, 0, 0), (0.15, 0.25, 1, 0), (0.25, 0.3, 1, 1), (0.3, 0.4, 2, 1)]
    assert {(r.half, round(r.bx - r.ax, 6)) for r in ST.split_half(seg).collect()} == {(0, 0.15), (1, 0.15)}
    fuzzy = ST.fuzzy_match(spark.createDataFrame([(1, 5, "Hlavni", "Hlavni ul"), (1, 6, "Hlavni", "Hlavni"), (2, 7, "abc", "xyz")], "id long, cand_id long, a string, b string"))
    assert [(r.id, r.cand_id) for r in fuzzy.collect()] == [(1, 6)]


def test_polygon_assembly(spark):
    lines = spark.createDataFrame([(1, "outer", [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)]), (1, "outer", [(4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]), (1, "inner", [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]), (2, "outer", [(0.0, 0.0), (1.0, 1.0)])], "rel_id long, role string, coords array<struct<lon:double,lat:double>>")
    (got,) = K.assemble_polygons(lines).collect()
    assert got.rel_id == 1 and len(got.geom) == 1 and len(got.geom[0].holes) == 1


def test_houses(spark):
    two = spark.createDataFrame([(1, "5/7", "A", "B"), (2, "9", "A", None)], "id long, number string, street string, street2 string")
    assert sorted((r.id, r.number, r.street) for r in H.split_second_street(two).collect()) == [(1, "5", "A"), (1, "7", "B"), (2, "9", "A")]
    line = [("s", i, 14.0 + i * 0.001, 50.0) for i in range(3)]
    pts = spark.createDataFrame(line, "stretch_id string, seq long, lon double, lat double")
    st = lambda a, b, step, last: spark.createDataFrame([("s", a, b, step, last)], "stretch_id string, first int, last int, step int, with_last boolean")
    got = {r.number: round(r.lon, 6) for r in H.place_along(st(2, 10, 2, True), pts).collect()}
    assert got == {"2": 14.0, "4": 14.0005, "6": 14.001, "8": 14.0015, "10": 14.002}
    assert {r.number for r in H.place_along(st(10, 2, 2, False), pts).collect()} == {"10", "8", "6", "4"}
    assert {r.number for r in H.place_along(st(1, 500, 1, True), pts).collect()} == {"1 - 500"}
    assert H.place_along(st(-1, -1, 1, True), pts).collect() == [] and {r.number for r in H.place_along(st(3, 3, 1, True), pts).collect()} == {"3"}
    wp = spark.createDataFrame([(1, 1, 14.0, 50.0, "1"), (1, 2, 14.001, 50.0, None), (1, 3, 14.002, 50.0, "5"), (1, 4, 14.003, 50.0, "7"), (2, 1, 14.0, 50.0, "x")], "way_id long, seq long, lon double, lat double, number string")
    kind = spark.createDataFrame([(1, "odd"), (2, "all")], "way_id long, kind string")
    assert sorted((r.way_id, r.number) for r in H.interpolate_houses(wp, kind).collect()) == [(1, "1"), (1, "3"), (1, "5"), (1, "7"), (2, "x")]
    named = spark.createDataFrame([(1, "A"), (2, "A"), (3, "A"), (4, "FIXME x"), (5, "B")], "id long, name string")
    city = spark.createDataFrame([(1, 7), (2, 7), (3, 8)], "id long, city_id long")
    kept, gone = H.houses_without_street(named, city)
    assert sorted(r.id for r in kept.collect()) == [1, 2]
    assert {r.id: r.reason for r in gone.collect()} == {3: "single by cities", 4: "bad name", 5: "single by name"}


def test_cities_for_place_stages(spark):
    rows = [
        (1, 10, 1, True, False, False, 1.0, 5.0),
        (2, 11, 2, False, True, True, 2.999, 5.0),
        (2, 12, 2, False, True, True, 3.0, 0.1),
        (3, 13, 5, False, False, False, 9.0, 0.5),
        (3, 14, 3, False, False, False, 9.0, 0.4),
        (4, 15, 3, False, False, False, 2.5, 7.0),
        (5, 16, 3, False, False, False, 3.0, 7.0),
    ]
    pairs = spark.createDataFrame(rows, "place_id long, city_id long, type_code int, in_list boolean, has_geom boolean, meets boolean, ratio double, importance double")
    got = {(r.place_id, r.city_id, r.stage) for r in P.cities_for_place(spark.range(1, 6), pairs).collect()}
    assert got == {(1, 10, 1), (2, 11, 2), (3, 13, 3), (3, 14, 4), (4, 15, 5)}


def test_center_city_order(spark):
    b = spark.createDataFrame([(1, "A", None, 5), (2, "B", None, None), (3, "C x", None, None), (4, "D", None, None), (5, "E", None, 5)], "id long, name string, short_name string, admin_center_id long")
    c = spark.createDataFrame([(5, "Q"), (6, "B"), (7, "C")], "id long, name string")
    inside = spark.createDataFrame([(6, 2), (7, 3)], "id long, poly_id long")
    over = spark.createDataFrame([(5, 7)], "boundary_id long, city_id long")
    assert {r.boundary_id: (r.city_id, r.stage) for r in P.center_city(b, c, inside, over).collect()} == {1: (5, 2), 2: (6, 3), 3: (7, 4), 4: (None, 5), 5: (7, 1)}


def test_poi_filters(spark):
    tags = spark.createDataFrame([(1, "amenity", "pub"), (2, "amenity", "pub"), (2, "phone", "1"), (3, "amenity", "bar"), (3, "phone", "2")], "id long, k string, v string")
    rules = spark.createDataFrame([("point", "amenity", "pub", "R", "quiet", {"phone": ["~"]}), ("point", "amenity", "pub", "R", "any", {}), ("way", "amenity", "bar", "R", "b", {"phone": ["9", "*"]}), ("way", "amenity", "bar", "R", "c", {"phone": ["9"]})], "kind string, key string, value string, root string, sub string, filters map<string,array<string>>")
    assert {(r.id, r.sub) for r in O.match_poi_rules(tags, rules).collect()} == {(1, "quiet"), (1, "any"), (2, "any"), (3, "b")}
    assert {(r.id, r.sub) for r in O.match_poi_rules(tags, rules, "way").collect()} == {(3, "b")}
    # Rules that differ in their filters only are all kept.
    two = spark.createDataFrame([("point", "amenity", "pub", "R", "s", {"phone": ["7"]}), ("point", "amenity", "pub", "R", "s", {"phone": ["1"]})], rules.schema)
    assert [r.id for r in O.match_poi_rules(tags, two).collect()] == [2]


def test_compaction_expands_to_the_same_tiles(spark):
    tiles = [(4, x, y) for x in range(4, 9) for y in range(4, 8)] + [(3, 7, 7), (4, 15, 15)]
    got = [tuple(r) for r in TI.compact_tiles(spark.createDataFrame(tiles, "z int, x int, y int"), 4).collect()]
    leaf = lambda z, x, y: {(i, j) for i in range(x << (4 - z), (x + 1) << (4 - z)) for j in range(y << (4 - z), (y + 1) << (4 - z))}
    assert set().union(*(leaf(*g) for g in got)) == set().union(*(leaf(*g) for g in tiles)) and (2, 1, 1) in got and len(got) == 1 + 4 + 1
    poly = spark.createDataFrame([(1, [square(14.0, 50.0, 0.5)])], f"id long, geom array<{POLYGON}>")
    cover = TI.tile_cover(poly, 8)
    assert {r.z for r in cover.collect()} == set(range(9)) and cover.where("z = 0").count() == 1
    meta = {r.name: r.value for r in TI.tile_metadata(cover, poly).collect()}
    assert meta["minzoom"] == "0" and meta["maxzoom"] == "8" and meta["bounds"].startswith("14.000000,50.000000")


def test_residential_areas(spark):
    size = 100 / 71500  # about a hundred metres of longitude at 50 degrees
    land = spark.createDataFrame([(1, [square(14.0, 50.0, 20 * size)]), (2, [square(14.0 + 40 * size, 50.0, 0.3 * size)])], f"id long, geom array<{POLYGON}>")
    houses = spark.createDataFrame([(1, 14.0 + 25 * size, 50.0)], "id long, lon double, lat double")
    areas, cells = A.residential_areas(land, houses, cell_m=25.0)
    got = areas.collect()
    assert len(got) == 1 and got[0]["class"] == "city" and cells.select("area").distinct().count() == 1


def test_entities_round_trip(spark):
    geoms = spark.createDataFrame([(1, [square(0, 0, 4, [(1, 1, 1)])], {"place": "x"}), (2, [square(9, 9, 1)], {"place": "y"})], f"id long, geom array<{POLYGON}>, tags map<string,string>")
    out = A.geometry_to_entities(geoms)
    assert out["node"].count() == 12 and out["way"].count() == 3
    (rel,) = out["relation"].collect()
    assert [m.role for m in rel.members] == ["outer", "inner"] and rel.tags == {"place": "x", "type": "multipolygon"}
    lines = E.resolve_ways(E.way_nodes(out["way"]), out["node"]).collect()
    assert sorted(len(x.coords) for x in lines) == [5, 5, 5] and all(x.coords[0] == x.coords[-1] for x in lines)


def test_readers(spark, tmp_path):
    (tmp_path / "a.osm").write_text("<osm><node id='1' lat='50.0' lon='14.0'><tag k='a' v='b'/></node><node id='2' lat='1' lon='2'/><way id='5'><nd ref='1'/><nd ref='2'/><tag k='h' v='p'/></way><relation id='7'><member type='way' ref='5' role='outer'/></relation></osm>")
    node, way, rel = (readers.read_osm_xml(spark, str(tmp_path / "a.osm"), k).orderBy("id").collect() for k in ("node", "way", "relation"))
    assert (node[0].lon, node[0].tags, node[1].tags) == (14.0, {"a": "b"}, {}) and way[0].refs == [1, 2] and rel[0].members[0].ref == 5
    (tmp_path / "cz.poly").write_text("cz\n1\n 0 0\n 4.0E+00 0\n 4 4\n 0 4\nEND\n!2\n 1 1\n 2 1\n 2 2\n 1 1\nEND\n3\n 9 9\n 10 9\n 10 10\n 9 9\nEND\nEND\n")
    (got,) = readers.read_poly(spark, str(tmp_path / "*.poly")).collect()
    assert got.file == "cz" and [len(p.outer) for p in got.geom] == [5, 4] and [len(p.holes) for p in got.geom] == [1, 0]
    writers.write_poi({"point": spark.range(3)}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/point")).count() == 3
    meta = {r.name: r.value for r in writers.dataset_metadata(spark, "cz", "Czechia", "d", ["cs", "en"], "2024.02.01", 3, "POLYGON").collect()}
    assert meta["osm_date"] == "1706745600000" and meta["language"] == "cs,en"


def test_streams_match_the_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    feed = events.select(F.lit("node").alias("type"), F.col("user_id").alias("id"), F.col("event_id").alias("version"), F.when(F.col("event_type") == "error", "delete").otherwise("modify").alias("action"), "ts")
    for i in range(3):
        feed.where(F.col("version") % 3 == i).write.mode("append").parquet(str(tmp_path / "feed"))
    stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "feed"))
    jobs.stream_changes(stream, str(tmp_path / "snap"), str(tmp_path / "ck")).awaitTermination()
    want = E.latest(feed).where("action <> 'delete'")
    got = jobs.snapshot(spark, str(tmp_path / "snap"))
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count()

    from terrane.operators.usage import usage_timeline

    events.coalesce(1).orderBy("ts").write.parquet(str(tmp_path / "ev"))
    source = spark.readStream.schema(events.schema).parquet(str(tmp_path / "ev"))
    q = jobs.stream_usage(source).writeStream.format("memory").queryName("usage").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = usage_timeline(events, "event_type")
    assert spark.table("usage").exceptAll(batch).count() == 0 and spark.table("usage").count() == batch.count()


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path):
    path = f"file:{tmp_path}/snap"
    cols = "type string, id long, version long, action string, ts timestamp_ntz, note string"
    row = lambda i, v, action="modify": ("node", i, v, action, None, f"{i}/{v}")
    batches = [[row(i, 1) for i in range(200)], [row(5, 3), row(6, 2, "delete")], [row(5, 2), row(6, 1)], [row(999, 1)], []]
    seen, written = [], []
    for n, rows in enumerate(batches):
        batch = spark.createDataFrame(rows, cols)
        jobs.merge_batch(batch, n, path, buckets=32)
        jobs.merge_batch(batch, n, path, buckets=32)  # run again: the same
        seen += rows
        want = E.latest(spark.createDataFrame(seen, cols)).where("action <> 'delete'")
        got = jobs.snapshot(spark, path)
        assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count()
        written.append(len(list((tmp_path / "snap" / "data" / f"batch={n}").glob("bucket=*"))))
    assert written[0] > 25 and written[1:] == [2, 2, 1, 0]
    # What was replaced two batches ago is gone.
    left = sum(len(list((tmp_path / "snap" / "data" / f"batch={n}").glob("bucket=*"))) for n in range(5))
    assert left <= len(list((tmp_path / "snap" / "data" / "batch=0").glob("bucket=*"))) + 5


def test_upsert_keeps_and_adds(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "region_id long, name string")
    batch = spark.createDataFrame([(2, "B"), (3, "c"), (1, None)], "region_id long, name string")
    assert sorted(tuple(r) for r in P.upsert_regions(dim, batch).collect()) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(Exception, match="no English name"):
        P.fill_languages(spark.createDataFrame([(1, None, "x", "y")], "id long, en string, old_en string, cs string"), ["en", "cs"], strict=True).collect()


def test_sub_city_junctions_and_periods(spark):
    from datetime import date

    from terrane.operators import routes as R
    from terrane.operators.usage import period_bounds

    polys = spark.createDataFrame([(5, [square(0, 0, 10)]), (6, [square(0, 0, 5)])], f"id long, geom array<{POLYGON}>")
    lines = spark.createDataFrame([(1, [(1.0, 1.0), (2.0, 2.0)]), (2, [(1.0, 1.0), (7.0, 7.0)]), (3, [(9.0, 9.0), (12.0, 9.0)])], "id long, coords array<struct<lon:double,lat:double>>")
    assert {tuple(r) for r in ST.sub_city(lines, polys).collect()} == {(1, 5), (2, 5)}
    node = spark.createDataFrame([(1, 0.0, 0.0, {"rwn_ref": "7"}), (2, 0.0, 0.0, {"x": "y"})], NODE)
    assert [(r.id, r.tags["hiking_node"]) for r in R.network_junctions(node).collect()] == [(1, "NLBE")]
    assert period_bounds("last_month", date(2024, 3, 15)) == ("2024-02-01", "2024-03-01")
    assert period_bounds("past_30_days", date(2024, 3, 15)) == ("2024-02-14", "2024-03-16")
    assert period_bounds("past_12_months", date(2024, 3, 15))[0] == "2023-03-01" and period_bounds("all", date(2024, 1, 1)) == (None, None)
