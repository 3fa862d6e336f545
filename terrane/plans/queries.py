"""The registered queries: operators applied to the lens over the given tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions import geo as G
from terrane.functions import tags as T
from terrane.functions import tiles as X
from terrane.lens import lens, with_lens
from terrane.operators import entities as E
from terrane.operators import houses as H
from terrane.operators import places as P
from terrane.operators import poi as O
from terrane.operators import routes as R
from terrane.operators import spatial as S
from terrane.operators import streets as ST
from terrane.operators import tiles as TI
from terrane.operators import usage as U
from terrane.operators.shared import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(*views: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL over the named views."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = with_lens(sql, *views) if views else sql
        return f

    return add


def _tags(**columns: str) -> F.Column:
    """A tag map of columns; empty values make no tag."""
    entries = F.array(*(F.struct(F.lit(k).alias("k"), F.col(c).alias("v")) for k, c in columns.items()))
    return F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull() & (e["v"] != "")))


def rel_info(spark: SparkSession, d: str) -> DataFrame:
    return lens(spark, d, "rel_info").select("id", F.map_from_entries(F.filter(F.array(*(F.struct(F.lit(k).alias("k"), F.col(c).alias("v")) for k, c in {"name": "name", "route": "route", "network": "network", "osmc:symbol": "osmc_symbol"}.items())), lambda e: e["v"] != "")).alias("tags"))


def way_points(spark: SparkSession, d: str) -> DataFrame:
    return E.resolve_way_points(lens(spark, d, "way_node"), lens(spark, d, "osm_node"))


def boundary(spark: SparkSession, d: str) -> DataFrame:
    ring = lens(spark, d, "boundary_ring").groupBy("id", "name", "admin_level").agg(F.array_sort(F.collect_list(F.struct("seq", "lon", "lat"))).alias("r"))
    outer = F.transform("r", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))
    none = F.array().cast("array<array<struct<lon:double,lat:double>>>")
    return ring.select("id", "name", F.col("admin_level").cast("int").alias("admin_level"), F.array(F.struct(outer.alias("outer"), none.alias("holes"))).alias("geom"))


_HAV = "2 * 6372800.0 * asin(sqrt(pow(sin(radians({b2} - {b1}) / 2), 2) + cos(radians({b1})) * cos(radians({b2})) * pow(sin(radians({a2} - {a1}) / 2), 2)))"


def _hav(a1: str, b1: str, a2: str, b2: str) -> str:
    return _HAV.format(a1=a1, b1=b1, a2=a2, b2=b2)


_POINTS = "wp AS (SELECT w.way_id, w.seq, w.ref, n.lon, n.lat FROM way_node w JOIN osm_node n ON w.ref = n.id)"


# Ways and nodes


@query("osm_node", "way_node", sql=f"""
WITH {_POINTS}, s AS (SELECT way_id, seq, lon, lat, lag(lon) OVER (PARTITION BY way_id ORDER BY seq) AS px, lag(lat) OVER (PARTITION BY way_id ORDER BY seq) AS py FROM wp)
SELECT way_id, count(*) AS n_points, round(coalesce(sum({_hav('px', 'py', 'lon', 'lat')}), 0), 3) AS length_m FROM s GROUP BY way_id HAVING count(*) > 1""")
def way_length(spark, d):
    lines = E.resolve_ways(lens(spark, d, "way_node"), lens(spark, d, "osm_node"))
    return lines.select(F.col("id").alias("way_id"), F.size("coords").cast("bigint").alias("n_points"), F.round(G.line_length_m(F.col("coords")), 3).alias("length_m"))


@query("osm_node", "way_node", sql=f"WITH {_POINTS} SELECT way_id, seq, ref, lon, lat FROM wp")
def resolve_way_points(spark, d):
    return way_points(spark, d)


@query("osm_node", "way_node", sql=f"""
WITH {_POINTS} SELECT way_id, min(lon) AS min_lon, min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat FROM wp GROUP BY way_id HAVING count(*) > 1""")
def way_bbox(spark, d):
    lines = E.resolve_ways(lens(spark, d, "way_node"), lens(spark, d, "osm_node"))
    return lines.select(F.col("id").alias("way_id"), G.bbox(F.col("coords")).alias("b")).select("way_id", "b.*")


@query("osm_node", "way_node", sql=f"""
WITH {_POINTS}, s AS (SELECT *, lead(lon) OVER (PARTITION BY way_id ORDER BY seq) AS nx, lead(lat) OVER (PARTITION BY way_id ORDER BY seq) AS ny FROM wp),
 l AS (SELECT way_id, sqrt((nx - lon) * (nx - lon) + (ny - lat) * (ny - lat)) AS len, (lon + nx) / 2 AS mx, (lat + ny) / 2 AS my, lon, lat, seq FROM s)
SELECT way_id, round(avg(lon), 7) AS mean_lon, round(avg(lat), 7) AS mean_lat, round((min(lon) + max(lon)) / 2, 7) AS box_lon, round((min(lat) + max(lat)) / 2, 7) AS box_lat,
 round(CASE WHEN sum(len) > 0 THEN sum(len * mx) / sum(len) ELSE arg_min(lon, seq) END, 7) AS cen_lon, round(CASE WHEN sum(len) > 0 THEN sum(len * my) / sum(len) ELSE arg_min(lat, seq) END, 7) AS cen_lat
FROM l GROUP BY way_id HAVING count(*) > 1""")
def way_centers(spark, d):
    lines = E.resolve_ways(lens(spark, d, "way_node"), lens(spark, d, "osm_node"))
    c = F.col("coords")
    many = lines.select(F.col("id").alias("way_id"), G.mean_center(c).alias("m"), G.bbox_center(c).alias("b"), G.line_centroid(c).alias("c"))
    return many.select("way_id", *(F.round(f"{k}.{a}", 7).alias(f"{n}_{a}") for k, n in (("m", "mean"), ("b", "box"), ("c", "cen")) for a in ("lon", "lat")))


@query("osm_node", "way_node", sql=f"""
WITH {_POINTS}, b AS (SELECT way_id, min(lon) AS a, min(lat) AS b, max(lon) AS c, max(lat) AS e FROM wp GROUP BY way_id HAVING count(*) > 1)
SELECT way_id, round({_hav('a', 'b', 'c', 'e')}, 3) AS diagonal_m, {_hav('a', 'b', 'c', 'e')} > 5000 AS too_long FROM b""")
def way_diagonal(spark, d):
    lines = E.resolve_ways(lens(spark, d, "way_node"), lens(spark, d, "osm_node"))
    size = G.diagonal_m(F.col("coords"))
    return lines.select(F.col("id").alias("way_id"), F.round(size, 3).alias("diagonal_m"), (size > 5000).alias("too_long"))


@query("osm_node", sql="SELECT id, CAST(round(lon * 100000) AS INTEGER) AS flon, CAST(round(lat * 100000) AS INTEGER) AS flat, CAST(least(511, floor((lon + 180) * 512 / 360)) AS INTEGER) AS wx, CAST(least(255, floor((lat + 90) * 256 / 180)) AS INTEGER) AS wy FROM osm_node")
def node_fixed_point(spark, d):
    n = lens(spark, d, "osm_node")
    w = G.world_cell(F.col("lon"), F.col("lat"))
    return n.select("id", G.to_fixed(F.col("lon")).alias("flon"), G.to_fixed(F.col("lat")).alias("flat"), w["x"].alias("wx"), w["y"].alias("wy"))


@query("osm_node", sql="""
SELECT id, round(30.0 * 180 / (6378000 * pi()), 9) AS plain_deg, round(degrees(30.0 / 6372800) / cos(radians(lat)), 9) AS dlon, round(degrees(30.0 / 6372800), 9) AS dlat,
 round(sqrt(pow(degrees(30.0 / 6372800) / cos(radians(lat)), 2) + pow(degrees(30.0 / 6372800), 2)), 9) AS diag, round(lon + degrees(100.0 / 6372800) / cos(radians(lat)), 9) AS off_lon, round(lat + degrees(50.0 / 6372800), 9) AS off_lat FROM osm_node""")
def metres_and_degrees(spark, d):
    n = lens(spark, d, "osm_node")
    v = G.m_to_dlon_dlat(F.col("lat"), F.lit(30.0))
    o = G.offset(F.col("lon"), F.col("lat"), F.lit(100.0), F.lit(50.0))
    cols = {"plain_deg": G.m_to_deg(F.lit(30.0)), "dlon": v["dlon"], "dlat": v["dlat"], "diag": G.dist_to_deg(F.col("lat"), F.lit(30.0)), "off_lon": o["lon"], "off_lat": o["lat"]}
    return n.select("id", *(F.round(c, 9).alias(k) for k, c in cols.items()))


@query("way_info", sql="SELECT id, name, highway IN ('track', 'path', 'cycleway') AS is_path FROM way_info WHERE highway <> 'platform'")
def street_ways(spark, d):
    return lens(spark, d, "way_info").where(T.is_street_way(F.col("highway"))).select("id", "name", T.is_path(F.col("highway")).alias("is_path"))


@query("way_info", sql="SELECT id FROM way_info WHERE highway IN ('track', 'path') OR surface = '1-URGENT'")
def tag_filter_ways(spark, d):
    tags = F.create_map(F.lit("highway"), F.col("highway"), F.lit("surface"), F.col("surface"))
    return lens(spark, d, "way_info").where(T.tags_match(tags, ["w/highway=track,path", "surface=1-URGENT", "n/highway=*"], "w")).select("id")


@query("osm_node", "way_node", "way_info", sql="SELECT n.id, n.lon, n.lat FROM osm_node n WHERE n.id IN (SELECT w.ref FROM way_node w JOIN way_info i ON w.way_id = i.id WHERE i.highway = 'track')")
def nodes_of_filtered_ways(spark, d):
    ways = lens(spark, d, "way_info").where(F.col("highway") == "track").select(F.col("id").alias("way_id"))
    refs = lens(spark, d, "way_node").join(ways, "way_id", "left_semi").select(F.col("ref").alias("id")).distinct()
    return lens(spark, d, "osm_node").join(refs, "id", "left_semi")


@query("osm_node", "way_node", sql="SELECT w.way_id, w.seq, n.id, n.lon, n.lat FROM way_node w JOIN osm_node n ON n.id = w.ref")
def nodes_by_id_list(spark, d):
    ids = lens(spark, d, "way_node").select("way_id", F.col("seq").alias("pos"), F.col("ref").alias("id"))
    return E.nodes_by_ids(lens(spark, d, "osm_node"), ids).select("way_id", F.col("pos").alias("seq"), "id", "lon", "lat")


# Relations


@query("member", sql="SELECT rel_id, type, role, count(*) AS n, min(ref) AS first_ref FROM member GROUP BY rel_id, type, role")
def member_roles(spark, d):
    return lens(spark, d, "member").groupBy("rel_id", "type", "role").agg(F.count(F.lit(1)).alias("n"), F.min("ref").alias("first_ref"))


@query("member", "way_node", "osm_node", sql="""
WITH g AS (SELECT w.way_id, count(*) AS n_points FROM way_node w JOIN osm_node n ON n.id = w.ref GROUP BY w.way_id HAVING count(*) > 1)
SELECT m.rel_id, m.ref, m.role, g.n_points FROM member m JOIN g ON m.ref = g.way_id WHERE m.type = 'way'""")
def relation_way_members(spark, d):
    ways = E.resolve_ways(lens(spark, d, "way_node"), lens(spark, d, "osm_node"))
    return E.resolve_members(lens(spark, d, "member"), ways).select("rel_id", "ref", "role", F.size("coords").cast("bigint").alias("n_points"))


@query("member", sql="""
-- recursive
WITH c AS (SELECT DISTINCT rel_id, ref FROM member WHERE type = 'relation'),
x AS (SELECT DISTINCT rel_id AS root, rel_id, 0 AS depth FROM member UNION SELECT x.root, c.ref, x.depth + 1 FROM x JOIN c ON x.rel_id = c.rel_id WHERE x.depth < 20)
SELECT root, rel_id, min(depth) AS depth FROM x GROUP BY root, rel_id""")
def nested_relations(spark, d):
    return E.expand_relations(lens(spark, d, "member"))


_TOURIST = "rel_info WHERE route IN ('bicycle', 'mtb', 'hiking', 'foot', 'ski', 'piste')"
_FIXED = "CASE WHEN route IN ('bicycle', 'mtb') AND network NOT IN ('lcn', 'rcn', 'ncn', 'icn') THEN 'lcn' WHEN route IN ('hiking', 'foot') AND network NOT IN ('lwn', 'rwn', 'nwn', 'iwn') THEN 'lwn' ELSE network END"


@query("rel_info", sql=f"SELECT id, route, nullif({_FIXED}, '') AS network, split_part(osmc_symbol, ':', 1) AS colour_part FROM {_TOURIST}")
def tourist_routes(spark, d):
    t = F.col("tags")
    rel = R.tourist_relations(rel_info(spark, d))
    return rel.select("id", t["route"].alias("route"), T.fix_network(t["route"], t["network"]).alias("network"), F.split_part(F.coalesce(t["osmc:symbol"], F.lit("")), F.lit(":"), F.lit(1)).alias("colour_part"))


_PARSED = """
 CASE WHEN osmc_symbol = '' THEN NULL ELSE 'yes' END AS osmc,
 CASE WHEN lower(split_part(osmc_symbol, ':', 1)) IN ('black', 'blue', 'brown', 'green', 'orange', 'purple', 'red', 'white', 'yellow') THEN split_part(osmc_symbol, ':', 1) END AS osmc_color,
 CASE WHEN osmc_symbol LIKE '%:%' THEN split_part(osmc_symbol, ':', 2) END AS osmc_background,
 CASE WHEN osmc_symbol LIKE '%:%:%' THEN split_part(osmc_symbol, ':', 3) END AS osmc_foreground,
 CASE WHEN osmc_symbol LIKE '%:%:%:%' AND length(split_part(osmc_symbol, ':', 4)) <= 5 THEN split_part(osmc_symbol, ':', 4) END AS osmc_text,
 CASE WHEN osmc_symbol LIKE '%:%:%:%:%' AND lower(split_part(osmc_symbol, ':', 5)) IN ('black', 'blue', 'brown', 'green', 'orange', 'purple', 'red', 'white', 'yellow') THEN split_part(osmc_symbol, ':', 5) END AS osmc_text_color"""


@query("rel_info", sql=f"SELECT id, {_PARSED} FROM rel_info")
def osmc_symbols(spark, d):
    p = T.parse_osmc(F.col("osmc_symbol"))
    return lens(spark, d, "rel_info").select("id", *(p[k].alias(k) for k in ("osmc", "osmc_color", "osmc_background", "osmc_foreground", "osmc_text", "osmc_text_color")))


_WAY_ROUTES = f"""
c AS (SELECT DISTINCT rel_id, ref FROM member WHERE type = 'relation'),
x AS (SELECT DISTINCT rel_id AS root, rel_id, 0 AS depth FROM member UNION SELECT x.root, c.ref, x.depth + 1 FROM x JOIN c ON x.rel_id = c.rel_id WHERE x.depth < 20),
t AS (SELECT id, name, route, {_FIXED} AS network, osmc_symbol FROM {_TOURIST}),
p AS (SELECT DISTINCT m.ref AS way_id, x.root AS rel_id FROM x JOIN t ON x.root = t.id JOIN member m ON m.rel_id = x.rel_id AND m.type = 'way')"""


@query("member", "rel_info", sql=f"-- recursive\nWITH {_WAY_ROUTES} SELECT way_id, rel_id FROM p")
def way_routes(spark, d):
    return R.way_routes(lens(spark, d, "member"), R.tourist_relations(rel_info(spark, d)))


@query("member", "rel_info", sql=f"""
-- recursive
WITH {_WAY_ROUTES} SELECT p.way_id, min(p.rel_id) AS rel_id, t.name, t.network FROM p JOIN t ON p.rel_id = t.id GROUP BY p.way_id, t.name, t.route, t.network, t.osmc_symbol""")
def way_tag_sets(spark, d):
    routes = R.tourist_relations(rel_info(spark, d))
    tags = stage(R.route_tags(routes), "route-tags")
    out = R.way_tag_sets(R.way_routes(lens(spark, d, "member"), routes), tags)
    return out.select("way_id", "rel_id", F.col("tags")["name"].alias("name"), F.coalesce(F.col("tags")["network"], F.lit("")).alias("network"))


_ORDER = f"""
q AS (SELECT p.way_id, p.rel_id, t.network, nullif(CASE WHEN lower(split_part(osmc_symbol, ':', 1)) IN ('black', 'blue', 'brown', 'green', 'orange', 'purple', 'red', 'white', 'yellow') THEN split_part(osmc_symbol, ':', 1) END, '') AS colour
  FROM p JOIN t ON p.rel_id = t.id WHERE t.route IN ('hiking', 'foot')),
r AS (SELECT *, coalesce(colour, 'red') AS c, max(CASE WHEN colour IS NULL AND network IN ('lwn', 'rwn', 'nwn', 'iwn') THEN 1 ELSE 0 END) OVER (PARTITION BY way_id) AS bare FROM q),
f AS (SELECT *, CASE WHEN bare = 1 AND c = 'red' THEN -1 ELSE min(CASE WHEN colour IS NOT NULL THEN rel_id END) OVER (PARTITION BY way_id, c) END AS spot FROM r)"""


@query("member", "rel_info", sql=f"""
-- recursive
WITH {_WAY_ROUTES}, {_ORDER} SELECT way_id, rel_id, colour, CASE WHEN spot IS NOT NULL THEN dense_rank() OVER (PARTITION BY way_id ORDER BY spot NULLS LAST) - 1 END AS osmc_order FROM f""")
def route_order(spark, d):
    routes = R.tourist_relations(rel_info(spark, d))
    tags = stage(R.route_tags(routes), "route-tags").select(F.col("id").alias("rel_id"), *(F.col("tags")[k].alias(n) for k, n in (("route", "route"), ("network", "network"), ("osmc_color", "colour"), ("osmc_foreground", "foreground"))))
    pairs = R.way_routes(lens(spark, d, "member"), routes).join(tags, "rel_id").withColumn("pos", F.col("rel_id"))
    return R.osmc_order(pairs).select("way_id", "rel_id", "colour", "osmc_order")


@query("member", "rel_info", "way_info", sql=f"""
-- recursive
WITH {_WAY_ROUTES}, s AS (SELECT p.way_id, min(p.rel_id) AS rel_id, t.name, t.network FROM p JOIN t ON p.rel_id = t.id GROUP BY p.way_id, t.name, t.route, t.network, t.osmc_symbol)
SELECT 1000 + row_number() OVER (ORDER BY s.way_id, s.rel_id) - 1 AS id, s.way_id, s.name, i.highway AS osmc_highway FROM s JOIN way_info i ON s.way_id = i.id""")
def tourist_ways(spark, d):
    way = lens(spark, d, "way_info").select("id", F.array().cast("array<bigint>").alias("refs"), F.create_map(F.lit("highway"), F.col("highway")).alias("tags"))
    out = R.build_routes(lens(spark, d, "member"), rel_info(spark, d), way, 1000)
    return out.select("id", "way_id", F.col("tags")["name"].alias("name"), F.col("tags")["osmc_highway"].alias("osmc_highway"))


# Places and boundaries

_INSIDE = """i AS (SELECT p.id, b.id AS poly_id, b.name AS b_name, b.admin_level, p.name, p.type_code, p.population, p.lon, p.lat FROM place p JOIN
 (SELECT id, name, admin_level, min(lon) AS x0, max(lon) AS x1, min(lat) AS y0, max(lat) AS y1 FROM boundary_ring GROUP BY id, name, admin_level) b
 ON p.lon >= b.x0 AND p.lon < b.x1 AND p.lat >= b.y0 AND p.lat < b.y1)"""
_LP = "CASE admin_level WHEN 8 THEN 1 WHEN 7 THEN 2 WHEN 6 THEN 3 WHEN 9 THEN 4 WHEN 10 THEN 5 ELSE 6 END"


def _inside(spark, d):
    return S.points_in_polygons(lens(spark, d, "place"), boundary(spark, d))


@query("place", "boundary_ring", sql=f"WITH {_INSIDE} SELECT id, poly_id FROM i")
def places_in_boundaries(spark, d):
    return _inside(spark, d)


@query("osm_node", "boundary_ring", sql="""
SELECT p.id, b.id AS poly_id FROM osm_node p JOIN (SELECT id, min(lon) AS x0, max(lon) AS x1, min(lat) AS y0, max(lat) AS y1 FROM boundary_ring GROUP BY id) b
 ON p.lon >= b.x0 AND p.lon < b.x1 AND p.lat >= b.y0 AND p.lat < b.y1""")
def nodes_in_boundaries(spark, d):
    return S.points_in_polygons(lens(spark, d, "osm_node"), boundary(spark, d))


@query("osm_node", "boundary_ring", sql="""
SELECT n.id FROM osm_node n WHERE NOT EXISTS (SELECT 1 FROM (SELECT min(lon) AS x0, max(lon) AS x1, min(lat) AS y0, max(lat) AS y1 FROM boundary_ring WHERE admin_level = 6 GROUP BY id) b
 WHERE n.lon >= b.x0 AND n.lon < b.x1 AND n.lat >= b.y0 AND n.lat < b.y1)""")
def nodes_outside_areas(spark, d):
    return S.points_outside(lens(spark, d, "osm_node"), boundary(spark, d).where("admin_level = 6")).select("id")


@query("place", "boundary_ring", sql=f"""
WITH {_INSIDE}, r AS (SELECT id, poly_id, CASE WHEN id % 7 = poly_id % 7 THEN 20 ELSE 30 END + {_LP} AS priority FROM i)
SELECT id AS city_id, poly_id AS boundary_id, priority FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY priority, poly_id) AS k FROM r) WHERE k = 1""")
def best_boundary_of_city(spark, d):
    pairs = _inside(spark, d).join(boundary(spark, d).select(F.col("id").alias("poly_id"), "admin_level"), "poly_id")
    pairs = pairs.select(F.col("id").alias("city_id"), F.col("poly_id").alias("boundary_id"), "admin_level", F.lit(False).alias("same_name"), F.lit(False).alias("is_place"), (F.col("id") % 7 == F.col("poly_id") % 7).alias("is_admin_center"), F.lit(False).alias("overridden"))
    return P.city_boundary(P.boundary_priority(pairs))


@query("place", "boundary_ring", sql=f"""
WITH {_INSIDE}, c AS (SELECT poly_id, min(id) AS city_id FROM i WHERE type_code <= 2 GROUP BY poly_id),
r AS (SELECT i.id, i.poly_id, c.city_id, {_LP} AS p FROM i JOIN c ON i.poly_id = c.poly_id WHERE i.type_code > 2 AND c.city_id <> i.id)
SELECT id, city_id AS parent_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p, poly_id, city_id) AS k FROM r) WHERE k = 1""")
def parent_cities(spark, d):
    place, inside = lens(spark, d, "place"), _inside(spark, d)
    center = inside.join(place.where("type_code <= 2").select("id"), "id", "left_semi").groupBy(F.col("poly_id").alias("boundary_id")).agg(F.min("id").alias("city_id"))
    return P.parent_city(place, inside, boundary(spark, d), center)


@query("place", "boundary_ring", sql=f"WITH {_INSIDE} SELECT id, max(poly_id) AS region_id FROM i GROUP BY id HAVING count(*) = 1")
def parent_regions(spark, d):
    inside = _inside(spark, d)
    single = inside.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("id")
    city = lens(spark, d, "place").withColumn("is_in", F.lit(None).cast("string"))
    return P.parent_region(city, inside.join(single, "id", "left_semi"), boundary(spark, d))


_RADIUS = "CASE type_code WHEN 1 THEN 10000.0 WHEN 2 THEN 4000.0 WHEN 3 THEN 1750.0 WHEN 4 THEN 750.0 WHEN 5 THEN 750.0 WHEN 6 THEN 400.0 END"


@query("place", "boundary_ring", sql=f"""
WITH {_INSIDE}, c AS (SELECT id, (min(lon) + max(lon)) / 2 AS x, (min(lat) + max(lat)) / 2 AS y FROM boundary_ring GROUP BY id)
SELECT i.id, i.poly_id, round({_hav('lon', 'lat', 'c.x', 'c.y')} / {_RADIUS} / (1.0 + CASE WHEN population >= 1000000 THEN 1.75 WHEN population > 500000 THEN 1.0 ELSE 0 END), 6) AS importance
FROM i JOIN c ON i.poly_id = c.id""")
def city_importance(spark, d):
    center = boundary(spark, d).select(F.col("id").alias("poly_id"), G.bbox_center(F.col("geom")[0]["outer"]).alias("c"))
    pairs = _inside(spark, d).join(lens(spark, d, "place"), "id").join(center, "poly_id")
    pairs = pairs.withColumn("dist_m", G.haversine_m(F.col("lon"), F.col("lat"), F.col("c.lon"), F.col("c.lat"))).withColumn("n_lang", F.lit(1))
    return P.relative_importance(pairs).select("id", "poly_id", F.round("importance", 6).alias("importance"))


_SQUARE = "abs(p.lat - h.lat) <= degrees({m} / 6372800) AND abs(p.lon - h.lon) <= degrees({m} / 6372800) / cos(radians(h.lat))"
_LEVELS = " UNION ALL ".join(f"SELECT h.id, p.id AS cand_id, {k} AS level FROM house h JOIN place p ON {_SQUARE.format(m=m)}" for k, m in enumerate((500.0, 1000.0, 2000.0, 4000.0)))


@query("house", "place", sql=f"""
WITH x AS ({_LEVELS}), n AS (SELECT id, level, count(*) AS n FROM x GROUP BY id, level),
c AS (SELECT id, coalesce(min(CASE WHEN n >= 5 THEN level END), 3) AS level FROM n GROUP BY id)
SELECT x.id, x.cand_id, x.level FROM x JOIN c ON x.id = c.id AND x.level = c.level""")
def city_candidates(spark, d):
    return S.candidates(lens(spark, d, "house"), lens(spark, d, "place"), [500.0, 1000.0, 2000.0, 4000.0], 5).select("id", "cand_id", "level")


_WIDE = " UNION ALL ".join(f"SELECT h.id, p.id AS cand_id, {k} AS level FROM house h JOIN place p ON {_SQUARE.format(m=m)}" for k, m in enumerate((5000.0, 10000.0, 20000.0, 40000.0)))


@query("house", "place", sql=f"""
WITH x AS ({_WIDE}), n AS (SELECT id, level, count(*) AS n FROM x GROUP BY id, level), c AS (SELECT id, coalesce(min(CASE WHEN n >= 5 THEN level END), 3) AS level FROM n GROUP BY id),
y AS (SELECT x.id, x.cand_id AS city_id, {_hav('h.lon', 'h.lat', 'p.lon', 'p.lat')} AS dist FROM x JOIN c ON x.id = c.id AND x.level = c.level JOIN house h ON h.id = x.id JOIN place p ON p.id = x.cand_id)
SELECT id, city_id, round(dist, 3) AS dist_m FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, city_id) AS k FROM y) WHERE k = 1""")
def nearest_cities(spark, d):
    near = S.nearest_candidate(lens(spark, d, "house"), lens(spark, d, "place"), [5000.0, 10000.0, 20000.0, 40000.0], 5)
    return near.withColumn("dist_m", F.round("dist_m", 3))


_SEG = f"{_POINTS}, sg AS (SELECT * FROM (SELECT way_id, lon AS ax, lat AS ay, lead(lon) OVER (PARTITION BY way_id ORDER BY seq) AS bx, lead(lat) OVER (PARTITION BY way_id ORDER BY seq) AS by_ FROM wp) WHERE bx IS NOT NULL)"
_T = "CASE WHEN (bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay) = 0 THEN 0 ELSE greatest(0, least(1, ((h.lon - ax) * (bx - ax) + (h.lat - ay) * (by_ - ay)) / ((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)))) END"


_NEAR = f"""{_SEG}, c AS (SELECT h.id, s.way_id AS line_id, lon, lat, ax, ay, bx, by_, {_T} AS t FROM house h JOIN sg s ON h.lon >= least(ax, bx) - 0.004 AND h.lon <= greatest(ax, bx) + 0.004 AND h.lat >= least(ay, by_) - 0.003 AND h.lat <= greatest(ay, by_) + 0.003),
m AS (SELECT id, line_id, {_hav('lon', 'lat', '(ax + t * (bx - ax))', '(ay + t * (by_ - ay))')} AS dist FROM c), nn AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(dist, 6), line_id) AS k FROM m)"""


@query("house", "osm_node", "way_node", sql=f"WITH {_NEAR} SELECT id, line_id, round(dist, 3) AS dist_m FROM nn WHERE k = 1 AND dist <= 200")
def nearest_street(spark, d):
    segments = S.line_segments(way_points(spark, d))
    out = S.nearest_segment(lens(spark, d, "house"), segments, 200.0)
    return out.select("id", "line_id", F.round("dist_m", 3).alias("dist_m"))


# Streets and houses


@query("house", sql="SELECT id, number, lon, lat FROM (SELECT *, row_number() OVER (PARTITION BY lon, lat, number ORDER BY id) AS k FROM house) WHERE k = 1")
def dedupe_houses(spark, d):
    return H.dedupe_houses(lens(spark, d, "house")).select("id", "number", "lon", "lat")


@query("house", sql="SELECT CAST(row_number() OVER (ORDER BY value) AS BIGINT) AS id, value FROM (SELECT DISTINCT CAST(postcode AS VARCHAR) AS value FROM house)")
def postcodes(spark, d):
    return E.dictionary(lens(spark, d, "house").withColumn("postcode", F.col("postcode").cast("string")), "postcode")


@query("house", sql="""
WITH p AS (SELECT value, CAST(row_number() OVER (ORDER BY value) AS BIGINT) AS k FROM (SELECT DISTINCT street AS value FROM house WHERE street <> ''))
SELECT h.id, coalesce(p.k, -1) AS street_id FROM house h LEFT JOIN p ON h.street = p.value""")
def house_dictionary_ids(spark, d):
    house = lens(spark, d, "house")
    return E.dictionary_ids(house, "street", E.dictionary(house, "street"), "street_id").select("id", "street_id")


@query("house", sql="SELECT h.* FROM house h WHERE h.id NOT IN (SELECT id FROM house WHERE street = '')")
def houses_not_seen(spark, d):
    house = lens(spark, d, "house")
    return E.without(house, house.where("street = ''"))


@query("house", sql="SELECT id, CASE WHEN number = '' THEN 'no number' WHEN street = '' THEN 'no street name' ELSE 'no street near' END AS reason FROM house WHERE id % 3 = 0 OR street = ''")
def removed_houses(spark, d):
    house = lens(spark, d, "house")
    return H.removed_houses(house, house.where("id % 3 <> 0 AND street <> ''"))


@query("house", sql="""
WITH b AS (SELECT street, CAST(round((min(lon) + max(lon)) / 2 * 100000) AS INTEGER) AS ox, CAST(round((min(lat) + max(lat)) / 2 * 100000) AS INTEGER) AS oy FROM house WHERE street <> '' GROUP BY street)
SELECT h.street, count(*) AS n, CAST(sum(CAST(round(lon * 100000) AS INTEGER) - ox) AS BIGINT) AS dx, CAST(sum(CAST(round(lat * 100000) AS INTEGER) - oy) AS BIGINT) AS dy FROM house h JOIN b ON h.street = b.street GROUP BY h.street""")
def street_payload(spark, d):
    house = lens(spark, d, "house").where("street <> ''").withColumn("street_id", F.col("street"))
    out = H.nest_houses(house, house.select("street_id", "lon", "lat"))
    total = lambda k: F.aggregate("houses", F.lit(0).cast("bigint"), lambda a, h: a + h[k])
    return out.select(F.col("street_id").alias("street"), F.size("houses").cast("bigint").alias("n"), total("dlon").alias("dx"), total("dlat").alias("dy"))


@query("way_info", "member", sql="""
-- recursive
WITH w AS (SELECT i.id AS way_id, i.name, m.rel_id AS city_id FROM way_info i JOIN member m ON m.type = 'way' AND m.ref = i.id),
h AS (SELECT DISTINCT w.way_id AS a, min(w2.way_id) AS b FROM w JOIN w w2 ON w.name = w2.name AND w.city_id = w2.city_id GROUP BY w.way_id, w.name, w.city_id),
e AS (SELECT a, b FROM h UNION SELECT b, a FROM h),
r AS (SELECT a AS way_id, a AS k FROM e UNION SELECT e.b, r.k FROM r JOIN e ON r.way_id = e.a)
SELECT way_id, min(k) AS street_id FROM r GROUP BY way_id""")
def joined_streets(spark, d):
    ways = lens(spark, d, "way_info").select(F.col("id").alias("way_id"), "name")
    cities = lens(spark, d, "member").where("type = 'way'").select(F.col("ref").alias("way_id"), F.col("rel_id").alias("city_id")).distinct()
    return ST.join_streets(ways, cities).join(cities.select("way_id").distinct(), "way_id", "left_semi")


@query("way_info", "house", sql="SELECT DISTINCT h.id, w.id AS street_id FROM house h JOIN way_info w ON lower(h.street) = lower(w.name) AND w.id % 25 = h.postcode")
def street_by_names(spark, d):
    street = lens(spark, d, "way_info").select("id", "name")
    in_city = street.select(F.col("id").alias("street_id"), (F.col("id") % 25).alias("city_id"))
    names = lens(spark, d, "boundary_ring").select(F.col("id"), "name").distinct()
    wanted = lens(spark, d, "house").join(names.withColumnRenamed("id", "postcode"), "postcode").select("id", F.col("name").alias("city"), "street")
    return ST.street_by_names(wanted, street, in_city, names)


@query("place", "house", sql="SELECT p.id AS city_id, p.name, p.lon FROM place p WHERE p.id NOT IN (SELECT postcode * 3 FROM house)")
def cities_without_streets(spark, d):
    held = lens(spark, d, "house").select((F.col("postcode") * 3).alias("city_id"), F.col("id").alias("street_id"))
    return ST.dummy_streets(lens(spark, d, "place"), held).select("city_id", "name", F.col("coords")[0]["lon"].alias("lon"))


@query("way_info", "house", sql="SELECT id, name FROM way_info w WHERE NOT (highway = 'track' AND id NOT IN (SELECT id FROM house))")
def pruned_paths(spark, d):
    street = lens(spark, d, "way_info").select("id", "name", T.is_path(F.col("highway")).alias("is_path"))
    return ST.prune_paths(street, lens(spark, d, "house").select(F.col("id").alias("street_id"))).select("id", "name")


@query("way_info", "member", sql="SELECT i.id, string_agg(DISTINCT CAST(m.rel_id AS VARCHAR), ',' ORDER BY CAST(m.rel_id AS VARCHAR)) AS cities FROM way_info i JOIN member m ON m.type = 'way' AND m.ref = i.id WHERE i.name = 'Street 5' AND m.rel_id % 10 IN (0, 5) GROUP BY i.id")
def same_name_in_cities(spark, d):
    held = lens(spark, d, "member").where("type = 'way'").select(F.col("ref").alias("street_id"), F.col("rel_id").alias("city_id"))
    held = held.withColumn("city_key", F.col("city_id")).withColumn("city_id", F.col("city_id") % 10)
    street = lens(spark, d, "way_info").where(F.col("name") == "Street 5")
    kept = ST.streets_in_cities(street, held, "Street 5", [0, 5]).select("id")
    every = held.where("city_id IN (0, 5)").join(kept.withColumnRenamed("id", "street_id"), "street_id")
    out = every.groupBy(F.col("street_id").alias("id")).agg(F.sort_array(F.collect_set(F.col("city_key").cast("string"))).alias("c"))
    return out.select("id", F.array_join("c", ",").alias("cities"))


# Points of interest


@query("poi_tag_long", sql="SELECT k AS key, count(*) AS n, k IN ('name', 'brand') AS used FROM poi_tag_long GROUP BY k")
def tag_usage(spark, d):
    return E.tag_usage(lens(spark, d, "poi_tag_long"), ["name", "brand"])


@query("poi_tag_long", sql="SELECT id, k, string_agg(v, '|' ORDER BY v) AS v FROM poi_tag_long GROUP BY id, k")
def poi_multi_values(spark, d):
    return O.multi_values(lens(spark, d, "poi_tag_long"))


@query("poi_tag_long", sql="""
WITH k AS (SELECT value, row_number() OVER (ORDER BY value) AS id FROM (SELECT DISTINCT k AS value FROM poi_tag_long WHERE k <> '')),
v AS (SELECT value, row_number() OVER (ORDER BY value) AS id FROM (SELECT DISTINCT v AS value FROM poi_tag_long WHERE v <> ''))
SELECT t.id AS poi_id, k.id AS key_id, v.id AS value_id FROM poi_tag_long t JOIN k ON t.k = k.value JOIN v ON t.v = v.value""")
def poi_eav(spark, d):
    return O.eav(lens(spark, d, "poi_tag_long"))[2]


def _rules(spark: SparkSession, d: str) -> DataFrame:
    """A rule for each brand, with a filter on the phone for every second one."""
    brand = lens(spark, d, "poi_tag_long").where("k = 'brand'").select("v").distinct()
    last = F.substring("v", -1, 1).cast("int")
    none = F.create_map().cast("map<string,array<string>>")
    filters = F.when(last % 3 == 0, F.create_map(F.lit("phone"), F.array(F.lit("~")))).when(last % 3 == 1, F.create_map(F.lit("phone"), F.array(F.lit("*")))).otherwise(none)
    return brand.select(F.lit("point").alias("kind"), F.lit("brand").alias("key"), F.col("v").alias("value"), F.substring("v", 1, 7).alias("root"), F.col("v").alias("sub"), filters.alias("filters"))


_MATCHED = """m AS (SELECT b.id, substr(b.v, 1, 7) AS root, b.v AS sub FROM poi_tag_long b LEFT JOIN (SELECT id, min(v) AS phone FROM poi_tag_long WHERE k = 'phone' GROUP BY id) p ON b.id = p.id
 WHERE b.k = 'brand' AND (TRY_CAST(right(b.v, 1) AS INTEGER) % 3 = 2 OR (TRY_CAST(right(b.v, 1) AS INTEGER) % 3 = 0 AND p.phone IS NULL) OR (TRY_CAST(right(b.v, 1) AS INTEGER) % 3 = 1 AND p.phone IS NOT NULL)))"""


@query("poi_tag_long", sql=f"WITH {_MATCHED} SELECT DISTINCT id, root, sub FROM m")
def poi_rules(spark, d):
    return O.match_poi_rules(lens(spark, d, "poi_tag_long"), _rules(spark, d))


@query("poi_tag_long", "osm_node", sql=f"WITH {_MATCHED} SELECT DISTINCT m.id, t.v AS name, n.lon, n.lat FROM m JOIN osm_node n ON n.id = m.id LEFT JOIN poi_tag_long t ON t.id = m.id AND t.k = 'name'")
def poi_points(spark, d):
    return O.build_poi(lens(spark, d, "osm_node"), lens(spark, d, "poi_tag_long"), _rules(spark, d))["point"]


# Tiles


@query("osm_node", sql="""
SELECT id, CAST(floor((lon + 180) / 360 * 16384) AS INTEGER) AS x, CAST(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 16384) AS INTEGER) AS y FROM osm_node""")
def node_tiles(spark, d):
    return lens(spark, d, "osm_node").select("id", X.tile_x(F.col("lon"), 14).alias("x"), X.tile_y(F.col("lat"), 14).alias("y"))


_TILES = "t AS (SELECT DISTINCT 16 AS z, CAST(floor((lon + 180) / 360 * 65536) AS INTEGER) AS x, CAST(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 65536) AS INTEGER) AS y FROM osm_node)"


def _node_tiles(spark, d, z=16):
    return lens(spark, d, "osm_node").select(F.lit(z).alias("z"), X.tile_x(F.col("lon"), z).alias("x"), X.tile_y(F.col("lat"), z).alias("y")).distinct()


def _compact_sql() -> str:
    parts, level = [_TILES, "l16 AS (SELECT x, y FROM t)"], 16
    out = []
    for z in range(16, 1, -1):
        parts.append(f"f{z} AS (SELECT x // 2 AS x, y // 2 AS y FROM l{z} GROUP BY 1, 2 HAVING count(*) = 4)")
        out.append(f"SELECT {z} AS z, x, y FROM l{z} WHERE (x // 2, y // 2) NOT IN (SELECT (x, y) FROM f{z})")
        parts.append(f"l{z - 1} AS (SELECT x, y FROM f{z})")
        level = z - 1
    out.append(f"SELECT {level} AS z, x, y FROM l{level}")
    return f"WITH {', '.join(parts)} {' UNION ALL '.join(out)}"


@query("osm_node", sql=_compact_sql())
def compacted_tiles(spark, d):
    return TI.compact_tiles(_node_tiles(spark, d), 16)


@query("osm_node", sql=f"""
WITH {_TILES}, c AS (SELECT x, min(y) AS lo, max(y) AS hi FROM t WHERE x % 2 = 0 GROUP BY x) SELECT t.z, t.x, t.y FROM t JOIN c ON t.x = c.x AND t.y BETWEEN c.lo AND c.hi""")
def extracted_tiles(spark, d):
    tiles = _node_tiles(spark, d)
    return TI.extract_tiles(tiles, tiles.where("x % 2 = 0"))


_TX, _TY = "CAST(floor(({x} + 180) / 360 * pow(2, z)) AS BIGINT)", "CAST(floor((1 - ln(tan(radians({y})) + 1 / cos(radians({y}))) / pi()) / 2 * pow(2, z)) AS BIGINT)"


@query("boundary_ring", sql=f"""
WITH b AS (SELECT id, min(lon) AS x0, max(lon) AS x1, min(lat) AS y0, max(lat) AS y1 FROM boundary_ring GROUP BY id), q AS (SELECT b.*, unnest(range(0, 15)) AS z FROM b),
c AS (SELECT id, z, {_TX.format(x='x0')} AS a, {_TX.format(x='x1')} AS b, {_TY.format(y='y1')} AS c, {_TY.format(y='y0')} AS d FROM q), x AS (SELECT *, unnest(range(a, b + 1)) AS x FROM c)
SELECT id, CAST(z AS INTEGER) AS z, CAST(x AS INTEGER) AS x, CAST(unnest(range(c, d + 1)) AS INTEGER) AS y FROM x""")
def boundary_tile_cover(spark, d):
    return TI.tile_cover(boundary(spark, d), 14)


@query("boundary_ring", sql="""
WITH b AS (SELECT min(lon) AS a, min(lat) AS b, max(lon) AS c, max(lat) AS d FROM boundary_ring)
SELECT 'bounds' AS name, printf('%.6f,%.6f,%.6f,%.6f', a, b, c, d) AS value FROM b UNION ALL SELECT 'center', printf('%.6f,%.6f', (a + c) / 2, (b + d) / 2) FROM b UNION ALL SELECT 'minzoom', '0' FROM b UNION ALL SELECT 'maxzoom', '10' FROM b""")
def tile_set_metadata(spark, d):
    b = boundary(spark, d)
    return TI.tile_metadata(TI.tile_cover(b, 10), b)


# Countries, regions, languages


@query("boundary_ring", sql="SELECT n.r_name AS country, b.id AS boundary_id, b.admin_level FROM (SELECT DISTINCT id, admin_level FROM boundary_ring) b JOIN nation ON b.id = n_nationkey JOIN region n ON n_regionkey = n.r_regionkey QUALIFY rank() OVER (PARTITION BY n.r_name ORDER BY b.admin_level) = 1")
def country_boundaries(spark, d):
    from terrane.lens import select

    nation = select(spark, d, "SELECT n_nationkey AS id, n_regionkey FROM nation")
    names = nation.join(select(spark, d, "SELECT r_regionkey AS n_regionkey, r_name AS name FROM region"), "n_regionkey").select("id", F.lower("name").alias("name"))
    wanted = select(spark, d, "SELECT r_name AS name FROM region")
    return P.country_boundary(P.match_countries(names, wanted), boundary(spark, d))


@query(sql="SELECT r_name AS country FROM region WHERE r_regionkey NOT IN (SELECT n_regionkey FROM nation WHERE n_nationkey % 2 = 0 AND n_regionkey <> 3)")
def missing_countries(spark, d):
    from terrane.lens import select

    found = select(spark, d, "SELECT n_regionkey FROM nation").where("n_regionkey <> 3")
    wanted = select(spark, d, "SELECT r_regionkey, r_name AS name FROM region")
    held = wanted.join(found.select(F.col("n_regionkey").alias("r_regionkey")), "r_regionkey", "left_semi").select(F.col("name").alias("country"))
    return P.missing_countries(wanted, held)


@query(sql="SELECT coalesce(b.k, d.k) AS region_id, coalesce(b.name, d.name) AS name, coalesce(b.parent, d.parent) AS parent FROM (SELECT c_custkey AS k, c_name AS name, c_nationkey AS parent FROM customer WHERE c_custkey % 3 <> 0) d FULL JOIN (SELECT c_custkey AS k, upper(c_name) AS name, CASE WHEN c_custkey % 4 = 0 THEN c_nationkey + 100 END AS parent FROM customer WHERE c_custkey % 2 = 0) b ON d.k = b.k")
def upserted_regions(spark, d):
    from terrane.lens import select

    dim = select(spark, d, "SELECT c_custkey AS region_id, c_name AS name, c_nationkey AS parent FROM customer WHERE c_custkey % 3 <> 0")
    batch = select(spark, d, "SELECT c_custkey AS region_id, upper(c_name) AS name, CASE WHEN c_custkey % 4 = 0 THEN c_nationkey + 100 END AS parent FROM customer WHERE c_custkey % 2 = 0")
    return P.upsert_regions(dim, batch)


@query(sql="SELECT s_suppkey AS id, s_name AS en, CASE WHEN s_suppkey % 3 = 0 OR s_suppkey % 3 = 1 THEN s_name ELSE concat('cs ', s_name) END AS cs, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE concat('de ', s_name) END AS de FROM supplier")
def filled_languages(spark, d):
    from terrane.lens import select

    rows = select(spark, d, """SELECT s_suppkey AS id, s_name AS en, concat('old ', s_name) AS old_en, CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 3 = 1 THEN concat('old ', s_name) ELSE concat('cs ', s_name) END AS cs,
 CASE WHEN s_suppkey % 2 = 1 THEN concat('de ', s_name) END AS de FROM supplier""")
    return P.fill_languages(rows, ["en", "cs", "de"])


# Changes and usage


@query("change_feed", sql="SELECT id, version, action FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, ts DESC, action DESC) AS k FROM change_feed) WHERE k = 1 AND action <> 'delete'")
def current_snapshot(spark, d):
    feed = lens(spark, d, "change_feed")
    return E.apply_changes(feed.where("version % 2 = 0"), feed.where("version % 2 = 1"), ["id"]).select("id", "version", "action")


@query("change_feed", sql="SELECT id, version, action FROM change_feed")
def merged_feeds(spark, d):
    feed = lens(spark, d, "change_feed").withColumn("type", F.lit("node"))
    return E.merge_entities(feed, feed.where("version % 3 = 0")).select("id", "version", "action")


@query(sql="SELECT CAST(ts AS DATE) AS date, event_type AS item, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' GROUP BY 1, 2")
def usage_timeline(spark, d):
    return U.usage_timeline(spark.read.parquet(f"{d}/events.parquet"), "event_type", start="2024-01-05", end="2024-01-25")


@query(sql="SELECT item, n, rank FROM (SELECT CAST(user_id AS VARCHAR) AS item, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, CAST(user_id AS VARCHAR)) AS rank FROM events WHERE event_type IN ('click', 'error') GROUP BY user_id) WHERE rank <= 10")
def usage_top(spark, d):
    return U.usage_top(spark.read.parquet(f"{d}/events.parquet"), "user_id", 10, ["click", "error"])


# Names


@query(sql="""SELECT p_partkey AS id, trim(regexp_replace(regexp_replace(strip_accents(concat('Žluť-', p_name, ' ', p_type)), '[~!@#$%^&*()\\-_+=`|\\\\:;''<>,./?]', ' ', 'g'), ' {2,}', ' ', 'g')) AS norm FROM part""")
def normalized_names(spark, d):
    from terrane.lens import select

    return select(spark, d, "SELECT p_partkey AS id, concat('Žluť-', p_name, ' ', p_type) AS name FROM part").select("id", T.normalize_name(F.col("name")).alias("norm"))


@query("place", sql="""SELECT id, CAST(1.0 + CASE WHEN population >= 1000000 THEN 1.75 WHEN population > 500000 THEN 1.0 WHEN id % 40 >= 30 THEN 1.5 WHEN id % 40 BETWEEN 12 AND 19 THEN 1.0 WHEN id % 40 BETWEEN 6 AND 11 THEN 0.75 ELSE 0 END AS DOUBLE) AS priority FROM place""")
def city_priorities(spark, d):
    return lens(spark, d, "place").select("id", T.city_priority(F.col("population"), F.col("id") % 40).alias("priority"))


@query("osm_node", "way_node", "member", "boundary_ring", sql="""
-- recursive
WITH b AS (SELECT id AS region_id, min(lon) AS x0, max(lon) AS x1, min(lat) AS y0, max(lat) AS y1 FROM boundary_ring GROUP BY id),
n AS (SELECT b.region_id, o.id FROM osm_node o JOIN b ON o.lon >= x0 AND o.lon < x1 AND o.lat >= y0 AND o.lat < y1), w AS (SELECT DISTINCT n.region_id, v.way_id AS id FROM n JOIN way_node v ON v.ref = n.id),
nn AS (SELECT region_id, id FROM n UNION SELECT w.region_id, v.ref FROM w JOIN way_node v ON v.way_id = w.id), r AS (SELECT DISTINCT w.region_id, m.rel_id AS id FROM w JOIN member m ON m.type = 'way' AND m.ref = w.id),
u AS (SELECT region_id, id FROM r UNION SELECT u.region_id, m.rel_id FROM u JOIN member m ON m.type = 'relation' AND m.ref = u.id)
SELECT region_id, id, 'node' AS type FROM nn UNION ALL SELECT region_id, id, 'way' FROM w UNION ALL SELECT region_id, id, 'relation' FROM u""")
def region_extract(spark, d):
    out = S.extract_regions(lens(spark, d, "osm_node"), lens(spark, d, "way_node"), lens(spark, d, "member"), boundary(spark, d), "complete_ways")
    return E.union_all(*(df.withColumn("type", F.lit(k)) for k, df in out.items()))


@query("osm_node", "way_node", "boundary_ring", sql=f"""
WITH {_POINTS}, b AS (SELECT id AS region_id, min(lon) AS x0, max(lon) AS x1, min(lat) AS y0, max(lat) AS y1 FROM boundary_ring GROUP BY id),
n AS (SELECT b.region_id, o.id FROM osm_node o JOIN b ON o.lon >= x0 AND o.lon < x1 AND o.lat >= y0 AND o.lat < y1)
SELECT n.region_id, 'node' AS type, n.id FROM n UNION ALL SELECT DISTINCT n.region_id, 'way', w.way_id FROM n JOIN way_node w ON w.ref = n.id""")
def region_extract_simple(spark, d):
    out = S.extract_regions(lens(spark, d, "osm_node"), lens(spark, d, "way_node"), lens(spark, d, "member"), boundary(spark, d), "simple")
    return E.union_all(*(out[k].withColumn("type", F.lit(k)) for k in ("node", "way"))).select("region_id", "type", "id")
