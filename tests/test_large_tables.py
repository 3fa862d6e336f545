"""What large tables bring: keys far up, points at and past a pole, groups of many equal rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture
def tables(tmp_path):
    """A folder of the given tables, of which some are replaced by a SELECT over the small ones."""

    def make(**replaced):
        c = duckdb.connect()
        for t in TABLES:
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
        for t in TABLES:
            c.execute(f"COPY ({replaced.get(t, f'SELECT * FROM {t}')}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        return str(tmp_path)

    return make


def agrees(spark, d, name):
    """The query's rows and those of its SQL are the same; gives their number."""
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    c.execute(f"CREATE TABLE want AS {entry.oracle_sql()[name]}")
    columns = [x[0] for x in c.execute("DESCRIBE want").fetchall()]
    want = sorted(map(repr, c.execute("SELECT * FROM want").fetchall()))
    got = sorted(repr(tuple(r)) for r in entry.queries()[name](spark, d).select(*columns).collect())
    assert got == want
    return len(got)


POLAR = "SELECT * REPLACE (999990 + p_partkey AS p_partkey) FROM part"


def test_squares_at_and_past_a_pole(spark, tables):
    assert agrees(spark, tables(part=POLAR), "node_squares") > 100


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_names_are_scored_once_a_pair(spark, tables):
    d = tables()
    assert agrees(spark, d, "fuzzy_street_names") > 50
    text = plan(entry.queries()["fuzzy_street_names"](spark, d))
    assert "Aggregate [a" in text[text.index("ArrowEvalPython") :]


def test_nearest_and_candidates_go_by_places(spark, tables, monkeypatch):
    """What is written on the way follows the distinct places, not the pairs of rows at them."""
    from terrane.operators import spatial as S

    d = tables(supplier="SELECT * REPLACE (s_suppkey + 100 * i AS s_suppkey) FROM supplier, range(40) AS r(i)", customer="SELECT * REPLACE (c_custkey + 499 * 397 * i AS c_custkey) FROM customer, range(10) AS r(i)")
    assert agrees(spark, d, "nearest_cities") > 1000
    staged = []
    monkeypatch.setattr(S, "stage", lambda df, name, own=S.stage: staged.append(own(df, name)) or staged[-1])
    rows = agrees(spark, d, "city_candidates")
    assert rows > 100 * sum(df.count() for df in staged) / 10


def test_a_list_with_repeated_positions_is_many_ranges(spark):
    from terrane.operators import entities as E

    ids = spark.range(4000).select((F.col("id") % 2).alias("pos"), "id")
    out = E.nodes_by_ids(spark.range(4000).select("id"), ids)
    with_parts = out.select("pos", "id", F.spark_partition_id().alias("p")).collect()
    assert [(r.pos, r.id) for r in with_parts] == sorted((i % 2, i) for i in range(4000))


def test_residential_cover_near_and_past_a_pole(spark, tables):
    d = tables(part="SELECT * REPLACE (CASE WHEN p_partkey < 3 THEN 987500 + p_partkey ELSE 1100000 + p_partkey END AS p_partkey) FROM part WHERE p_partkey < 60")
    assert agrees(spark, d, "residential_cover") > 100


def test_residential_areas_at_a_pole(spark, tables):
    d = tables(part=POLAR)
    cells = {tuple(r) for r in entry.queries()["residential_cells"](spark, d).select("area", "n_cells").collect()}
    assert cells and max(n for _, n in cells) < 50 * 4e7 / 10


def test_lines_to_a_pole_and_past_it_are_passed_over(spark):
    from terrane.operators import spatial as S

    points = spark.createDataFrame([(1, 14.0001, 50.0001), (2, 14.0001, 60.0), (3, 14.0, 89.0)], "id long, lon double, lat double")
    lines = spark.createDataFrame([(1, 14.0, 50.0, 14.0, 50.0002), (2, 14.0, 88.0, 14.0, 90.0), (3, 14.0, 70.0, 14.1, 97.0)], "line_id long, ax double, ay double, bx double, by double")
    assert {(r.id, r.line_id) for r in S.nearest_segment(points, lines, 200.0).collect()} == {(1, 1), (3, 2)}


def test_streets_by_names_are_not_shuffled_as_pairs(spark, tables):
    from terrane.operators import streets as ST

    d = tables()
    agrees(spark, d, "street_by_names")
    text = plan(entry.queries()["street_by_names"](spark, d))
    assert "Aggregate" not in text[: text.index("Join")]
    wanted = spark.createDataFrame([(1, "Ulm", "High St"), (1, "Bern", "high st"), (2, "Bern", "Low St"), (3, None, "Low St")], "id long, city string, street string")
    street = spark.createDataFrame([(10, "High St"), (11, "Low St")], "id long, name string")
    held = spark.createDataFrame([(10, 7), (10, 8), (11, 8), (11, 8)], "street_id long, city_id long")
    names = spark.createDataFrame([(7, "ulm"), (8, "Bern"), (8, "Ulm")], "id long, name string")
    assert sorted(map(tuple, ST.street_by_names(wanted, street, held, names).collect())) == [(1, 10), (2, 11)]


def test_lines_go_through_python_by_batches(spark, tables):
    from terrane.operators import streets as ST

    d = tables()
    assert agrees(spark, d, "merged_lines") > 1000
    assert "FlatMapGroups" not in plan(entry.queries()["merged_lines"](spark, d))
    lines = spark.createDataFrame([(1, [(0.0, 0.0), (1.0, 0.0)]), (1, [(2.0, 0.0), (1.0, 0.0)]), (2, None), (3, [(5.0, 5.0)])], "street_id long, coords array<struct<lon:double,lat:double>>")
    got = {r.street_id: [[tuple(p) for p in x] for x in r.geom] for r in ST.merge_lines(lines).collect()}
    assert got == {1: [[(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)]], 2: [], 3: []}


def test_short_lines_are_simplified_as_long_ones(spark, monkeypatch):
    import random

    from terrane.operators import kernels as K

    rnd = random.Random(5)
    lines = [[(rnd.randrange(50) * 0.002, rnd.randrange(400) * 0.002) for _ in range(rnd.randrange(1, 14))] for _ in range(400)]
    short = [K.simplify(x, 0.01) for x in lines]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)] + [(400, None)], "id long, c array<struct<lon:double,lat:double>>")
    through = {r.id: [tuple(p) for p in r.c] for r in df.select("id", K.simplify_line(F.col("c"), 0.01).alias("c")).collect()}
    assert through == dict(enumerate([*short, []]))
    monkeypatch.setattr(K, "SHORT", 0)
    assert short == [K.simplify(x, 0.01) for x in lines]


def test_a_key_of_many_rows_is_not_shuffled(spark):
    from terrane.operators.shared import join_skewed, stage

    rows = stage(spark.range(3000).select((F.when(F.col("id") < 2500, 0).otherwise(F.col("id"))).alias("k"), "id"), "rows")
    table = spark.range(2900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = join_skewed(rows, table, "k", many=1000)
    assert sorted(map(tuple, out.collect())) == [(0 if i < 2500 else i, i, 0 if i < 2500 else 2 * i) for i in range(2900)]
    assert "leftanti" in plan(out).lower().replace(" ", "")


def test_segments_beside_all_polygons_go_first(spark):
    from terrane.operators import spatial as S

    ring = lambda x, y: ([(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)], [])
    shapes = spark.createDataFrame([(1, [ring(0.0, 0.0)]), (2, [ring(5.0, 0.0)])], "id long, geom array<struct<outer:array<struct<lon:double,lat:double>>,holes:array<array<struct<lon:double,lat:double>>>>>")
    lines = spark.createDataFrame([(1, [(-1.0, 0.5), (7.0, 0.5)]), (2, [(0.0, 2.0), (9.0, 40.0)]), (3, [(2.0, 0.5), (3.0, 0.5)]), (4, [(-3.0, -1.0), (1.0, 3.5), (1.0, 1.0)])], "id long, coords array<struct<lon:double,lat:double>>")
    out = S.lines_in_polygons(lines, shapes)
    assert sorted(map(tuple, out.collect())) == [(1, 1), (1, 2), (4, 1)]
    assert "_w#" in plan(out)


def test_grid_runs_are_the_pieces_of_the_grid_in_few_rows(spark):
    from terrane.operators import streets as ST

    rows = [(1, 0.1, 0.1, 0.4, 0.2), (2, 0.4, 0.9, 0.31, -0.52), (3, 0.2, 0.2, 0.2, 0.2), (4, -0.2, 3.07, 0.7, 0.01), (5, 0.05, 0.07, 0.9, 0.07)]
    seg = spark.createDataFrame(rows, "line_id long, ax double, ay double, bx double, by double")
    pieces = ST.split_grid(seg).collect()
    runs = ST.grid_runs(seg).collect()
    of_runs = sorted((r.line_id, r.c, k) if r.upright else (r.line_id, k, r.c) for r in runs for k in range(r.first, r.last + 1))
    assert of_runs == sorted((p.line_id, p.cx, p.cy) for p in pieces) and len(runs) < len(pieces)
    length = lambda ps, i: sum(((p.bx - p.ax) ** 2 + (p.by - p.ay) ** 2) ** 0.5 for p in ps if p.line_id == i)
    assert all(abs(length(runs, i) - length(pieces, i)) < 1e-12 for i in range(1, 6))


def test_gridded_lines_do_not_grow_with_the_way(spark, tables, monkeypatch):
    """Nodes far up make long segments; what is cut on the way follows the segments, not their length."""
    from terrane.operators import streets as ST

    d = tables(part="SELECT * REPLACE (p_partkey + 2000 * (p_partkey % 500) AS p_partkey) FROM part", lineitem="SELECT * REPLACE (l_partkey + 2000 * (l_partkey % 500) AS l_partkey) FROM lineitem")
    made = []
    for name in ("split_grid", "grid_runs"):
        monkeypatch.setattr(ST, name, lambda df, deg, own=getattr(ST, name, None): made.append(own(df, deg)) or made[-1])
    assert agrees(spark, d, "gridded_lines") > 1000
    assert made[0].count() < 3 * 6005


def test_extracts_make_the_ways_once(spark, tables, monkeypatch):
    """Ways and members are made once, however often they are asked; results are those of the SQL."""
    from terrane.plans import jobs

    d = tables()
    asked = []
    monkeypatch.setattr(jobs.S, "extract_regions", lambda node, way_node, member, *rest, own=jobs.S.extract_regions: asked.append((way_node, member)) or own(node, way_node, member, *rest))
    assert agrees(spark, d, "extracted_entities") > 10
    assert agrees(spark, d, "extracted_smart") > 1000
    assert all("Window" not in plan(df) and "Join" not in plan(df) and "Relation" in plan(df) for pair in asked for df in pair)


def test_polygons_of_one_shape_meet_lines_once(spark):
    """What is made on the way follows the distinct shapes; the result has every polygon."""
    from terrane.operators import spatial as S

    square = lambda x: [([(x, 0.0), (x + 1, 0.0), (x + 1, 1.0), (x, 1.0), (x, 0.0)], [])]
    rows = [(i, square(float(i % 2))) for i in range(40)]
    polygons = spark.createDataFrame(rows, "id long, geom array<struct<outer:array<struct<lon:double,lat:double>>,holes:array<array<struct<lon:double,lat:double>>>>>")
    lines = spark.createDataFrame([(1, [(0.5, -1.0), (0.5, 2.0)]), (2, [(0.5, 0.5), (1.5, 0.5)]), (3, [(5.0, 5.0), (6.0, 6.0)])], "id long, coords array<struct<lon:double,lat:double>>")
    shapes = S.shapes_of(polygons)
    index = S.stage(S.polygon_index(shapes[0]), "index")
    assert shapes[0].count() == 2 and index.select("poly_id").distinct().count() == 2
    key = lambda df: sorted(tuple(r) for r in df.select("id", "poly_id").collect())
    assert key(S.lines_in_shapes(lines, shapes, index)) == key(S.lines_in_polygons(lines, polygons)) == sorted([(1, i) for i in range(0, 40, 2)] + [(2, i) for i in range(40)])
    points = lines.select("id", *(lines["coords"][1][c].alias(c) for c in ("lon", "lat")))
    assert key(S.points_in_shapes(points, shapes, index)) == key(S.points_in_polygons(points, polygons)) == [(2, i) for i in range(1, 40, 2)]


def test_pairs_of_places_and_cities_are_not_broadcast(spark, monkeypatch):
    from terrane.plans import jobs

    plans = {}
    monkeypatch.setattr(jobs, "stage", lambda df, name, own=jobs.stage: plans.update({name: plan(df)}) or own(df, name))
    spot = spark.createDataFrame([(1, [], 14.0, 50.0)], "id long, in_list array<string>, lon double, lat double")
    places = spark.createDataFrame([(7, "A", 1, 100, ["A"], 14.0, 50.001, None)], "id long, name string, type_code int, population int, names array<string>, lon double, lat double, geom array<string>")
    assert [tuple(r) for r in jobs.cities_of(spot, spark.createDataFrame([(1, 7)], "id long, poly_id long"), places).collect()] == [(1, 7)]
    assert "strategy=merge" in plans["pairs"]
