"""What the address build writes on its way follows places and polygons, not the pairs of all spots and cities."""

import random

from pyspark.sql import functions as F

from terrane.functions import geo as G
from terrane.operators import places as P
from terrane.operators import spatial as S
from terrane.operators import streets as ST
from terrane.plans import jobs
from terrane.schema import POLYGON

PLACE = f"id long, name string, type_code int, population int, names array<string>, lon double, lat double, geom array<{POLYGON}>"


def square(x, y, size):
    return [([(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)], [])]


def every_pair(spot, met, places):
    """The same by all pairs of spots and candidate cities, one by one."""
    near = S.candidates(spot, places, [5000.0, 10000.0, 20000.0, 40000.0], 40).select(F.col("id").alias("place_id"), F.col("cand_id").alias("city_id"))
    met = met.select(F.col("id").alias("place_id"), F.col("poly_id").alias("city_id"), F.lit(True).alias("meets"))
    pairs = near.union(met.select("place_id", "city_id")).distinct().join(met, ["place_id", "city_id"], "left").join(spot.select(F.col("id").alias("place_id"), "in_list", F.col("lon").alias("x"), F.col("lat").alias("y")), "place_id")
    pairs = pairs.join(places.select(F.col("id").alias("city_id"), "name", "type_code", "population", F.size("names").alias("n_lang"), "lon", "lat", F.col("geom").isNotNull().alias("has_geom")), "city_id")
    pairs = P.relative_importance(pairs.withColumn("dist_m", G.haversine_m(F.col("x"), F.col("y"), F.col("lon"), F.col("lat"))))
    named = F.coalesce(F.array_contains("in_list", F.col("name")), F.lit(False)).alias("in_list")
    pairs = pairs.select("place_id", "city_id", "type_code", named, "has_geom", F.coalesce("meets", F.lit(False)).alias("meets"), (F.col("dist_m") / P.radius_m(F.col("type_code"))).alias("ratio"), "importance")
    return P.cities_for_place(spot.select("id"), S.stage(pairs, "every-pair")).select(F.col("place_id").alias("id"), "city_id")


def test_cities_of_one_place_and_kind_meet_a_spot_once(spark, monkeypatch):
    rng = random.Random(3)
    shapes = [square(14.0 + 0.05 * (i % 3), 50.0 + 0.05 * (i // 3), 0.08) for i in range(6)]
    # Few places, so many cities share one; few shapes, or none.
    spots = [(14.0 + 0.04 * rng.randrange(5), 50.0 + 0.03 * rng.randrange(5)) for _ in range(12)]
    rows = [(i, f"City {i % 90}", rng.randint(1, 6), rng.choice([0, 600_000, 2_000_000]), ["A"] * rng.choice([1, 7, 13, 30]), *rng.choice(spots), rng.choice([None, None, *shapes])) for i in range(1, 301)]
    places = spark.createDataFrame(rows, PLACE).cache()
    listed = lambda i: None if i % 7 == 0 else [f"City {rng.randrange(90)}", "City 5"] if i % 5 == 0 else []
    spot = spark.createDataFrame([(i, listed(i), 14.0 + rng.random() * 0.3, 50.0 + rng.random() * 0.3) for i in range(150)] + [(900 + i, [], *at) for i, at in enumerate(spots)], "id long, in_list array<string>, lon double, lat double").cache()
    own = S.shapes_of(places.where("geom IS NOT NULL").select("id", "geom"))
    met = S.points_in_polygons(spot, own[0])
    staged = []
    monkeypatch.setattr(jobs, "stage", lambda df, name, keep=jobs.stage: (out := keep(df, name), staged.append((name, out)))[0])
    got = sorted(map(tuple, jobs.cities_of(spot, met, places, own[1]).collect()))
    want = sorted(map(tuple, every_pair(spot, S.points_in_polygons(spot, places.where("geom IS NOT NULL").select("id", "geom")), places).collect()))
    assert got == want and len(got) > 1000
    # The nearest of them is known by the least of each class.
    near = lambda pairs: sorted(map(tuple, S.nearest_city(spot, pairs, places).select("id", "city_id").collect()))
    least = jobs.cities_of(spot, met, places, own[1], every=False)
    assert near(least) == near(spark.createDataFrame(want, "id long, city_id long")) and least.count() < len(want)
    # Spots that name no city are in the first pairs: none meets all of the 300 cities.
    pairs = next(df for name, df in staged if name == "pairs")
    assert 0 < pairs.groupBy("place_id").count().agg(F.max("count")).first()[0] < 250


def test_clusters_go_through_python_by_batches(spark):
    line = lambda x: [(x, 50.0), (x + 0.001, 50.0)]
    rows = [(i, 10 * i, line(14.0)) for i in range(50)] + [(77, 1001, line(14.0)), (77, 1002, line(14.002)), (77, 1003, line(15.0))]
    parts = spark.createDataFrame(rows, "street_id long, part_id long, coords array<struct<lon:double,lat:double>>")
    out = ST.split_clusters(parts)
    assert "FlatMapGroups" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in out.collect()} == {(10 * i, 10 * i) for i in range(50)} | {(1001, 1001), (1002, 1001), (1003, 1003)}


def test_cities_of_one_polygon_cut_a_street_once(spark):
    """A long street through two polygons, each of which three cities have."""
    rows = [(i, f"City {i}", 1, 0, ["A"], 14.05 + 0.2 * (i % 2), 50.05, square(14.0 + 0.2 * (i % 2), 50.0, 0.2)) for i in range(1, 7)]
    places = spark.createDataFrame(rows, PLACE).withColumn("parent_city_id", F.lit(None).cast("long"))
    road = spark.createDataFrame([(1, "Long Street", False, [], [(14.02, 50.05), (14.36, 50.05)])], "id long, name string, is_path boolean, in_list array<string>, coords array<struct<lon:double,lat:double>>")
    way_city, street, in_city = jobs.streets(road, places)
    assert {r.city_id for r in way_city.collect()} == set(range(1, 7))
    found = sorted((round(min(p.lon for x in r.geom for p in x), 6), round(max(p.lon for x in r.geom for p in x), 6)) for r in street.collect())
    assert found == [(14.02, 14.2), (14.2, 14.36)]
    assert {r.city_id for r in in_city.collect()} == set(range(1, 7))


def test_streets_of_similar_names_are_not_shuffled_as_met(spark, monkeypatch):
    """What a house meets goes to its best by a sum in each task; nothing is joined to it before."""
    plans = {}
    monkeypatch.setattr(jobs, "stage", lambda df, name, keep=jobs.stage: plans.update({name: df._jdf.queryExecution().optimizedPlan().toString()}) or keep(df, name))
    line = lambda y: [[(14.0, y), (14.002, y)]]
    streets = spark.createDataFrame([(1, "Main Street", line(50.001)), (2, "Main Streets", line(50.002)), (3, "Main Street", line(50.0025))], "id long, name string, geom array<array<struct<lon:double,lat:double>>>")
    houses = spark.createDataFrame([(10, 10, "Main Stree", None, 14.001, 50.0), (11, 11, "Mein Streets", None, 14.001, 50.0021)], "row long, id long, street_name string, place string, lon double, lat double")
    places = spark.createDataFrame([], PLACE)
    got = {r.row: r.street_id for r in jobs.link_houses(houses, streets, places).collect()}
    assert got == {10: 1, 11: 2}
    # The first join from the top is that of cells.
    assert "_cx" in next(x for x in plans["alike-houses"].splitlines() if "Join" in x)
