"""Residential areas by a dissolve on a grid, and geometries written back as entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions import geo as G
from terrane.operators import runs as R
from terrane.operators.entities import with_seq
from terrane.operators.shared import stage


def residential_areas(landuse: DataFrame, buildings: DataFrame, cell_m: float = 10.0, house_m: float = 30.0, gap_m: float = 30.0, least_m: float = 90.0, hole_m: float = 500.0, city_m: float = 1500.0) -> tuple[DataFrame, DataFrame]:
    """Areas ``area, n_cells, area_m2, class`` and the runs of cells that they are made of, ``area, cy, x0, x1``.

    Landuse polygons (``id, geom``) and squares round buildings outside them (``id, lon, lat``) are covered with cells;
    gaps up to ``gap_m`` are closed by growing and shrinking, areas under ``least_m`` squared dropped, holes under
    ``hole_m`` squared filled, and areas over ``city_m`` squared are of class city, others village. Metres are metres at
    any latitude. This differs from a polygon union in the detail of the outline, not in the class.
    """
    cover = R.merged(R.polygon_runs(landuse, cell_m).union(R.square_runs(buildings, house_m, cell_m)))
    solid = stage(R.closed(cover, gap_m, cell_m), "solid")
    filled = stage(R.merged(solid.union(R.small_holes(solid, hole_m, cell_m))), "filled")
    runs = stage(R.joined(filled), "areas")
    n = F.col("x1") - F.col("x0") + 1
    sizes = runs.groupBy("area").agg(F.sum(n).alias("n_cells"), F.sum(n * cell_m * cell_m * R.shrinkage(cell_m)).alias("area_m2"))
    kept = sizes.where(F.col("area_m2") > least_m * least_m).withColumn("class", F.when(F.col("area_m2") > city_m * city_m, "city").otherwise("village"))
    return kept, runs.join(kept.select("area"), "area", "left_semi")


def geometry_to_entities(geoms: DataFrame, node_base: int = 1_001_000_000_000_000, way_base: int = 1_002_000_000_000_000, relation_base: int = 1_003_000_000_000_000) -> dict[str, DataFrame]:
    """Multi-polygons (``id, geom, tags``) as nodes, closed ways and, where there are holes, relations with outer and inner members.

    A closed way ends with the node that it begins with. Polygons without holes are ways that carry the tags.
    """
    polygons = geoms.select("id", "tags", F.posexplode("geom").alias("part", "p"))
    rings = polygons.select("id", "tags", "part", F.size(F.coalesce(F.col("p.holes"), F.array().cast("array<array<struct<lon:double,lat:double>>>"))).alias("n_holes"), F.posexplode(F.concat(F.array("p.outer"), F.coalesce(F.col("p.holes"), F.array().cast("array<array<struct<lon:double,lat:double>>>")))).alias("ring", "coords"))
    ways = with_seq(rings, ["id", "part", "ring"], way_base, "way_id")
    points = ways.select("way_id", F.posexplode(F.slice("coords", F.lit(1), F.size("coords") - 1)).alias("seq", "c")).select("way_id", "seq", "c.lon", "c.lat")
    nodes = with_seq(points, ["way_id", "seq"], node_base, "id")
    refs = nodes.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("seq", "id"))).alias("r")).select("way_id", F.transform("r", lambda x: x["id"]).alias("r"))
    refs = refs.select("way_id", F.concat("r", F.slice("r", 1, 1)).alias("refs"))
    empty = F.create_map().cast("map<string,string>")
    way = ways.join(refs, "way_id").select(F.col("way_id").alias("id"), "refs", F.when(F.col("n_holes") == 0, F.col("tags")).otherwise(empty).alias("tags"))
    member = F.struct(F.col("ring").alias("ring"), F.lit("way").alias("type"), F.col("way_id").alias("ref"), F.when(F.col("ring") == 0, "outer").otherwise("inner").alias("role"))
    grouped = ways.where("n_holes > 0").groupBy("id", "part").agg(F.array_sort(F.collect_list(member)).alias("m"), F.first("tags").alias("tags"))
    typed = F.transform("m", lambda m: F.struct(m["type"].alias("type"), m["ref"].alias("ref"), m["role"].alias("role")))
    mp = F.create_map(F.lit("type"), F.lit("multipolygon"))
    relation = with_seq(grouped, ["id", "part"], relation_base, "rel_id").select(F.col("rel_id").alias("id"), typed.alias("members"), F.map_concat(F.map_filter("tags", lambda k, _: k != "type"), mp).alias("tags"))
    return {"node": nodes.select("id", "lon", "lat"), "way": way, "relation": relation}


def tag_land(polygons: DataFrame) -> DataFrame:
    """Land polygons with the tags of land in the sea map over their own."""
    from terrane.functions.tags import merge_tags

    return polygons.withColumn("tags", merge_tags(F.col("tags"), F.create_map(F.lit("natural"), F.lit("nosea"), F.lit("layer"), F.lit("-4"))))


def sea_frame(regions: DataFrame, shrink: float = 0.00006) -> DataFrame:
    """``id, coords, tags``: each region's envelope, slightly smaller, as a closed way of the sea."""
    b = G.geom_bbox(F.col("geom"))
    w, s, e, n = b["min_lon"] + shrink, b["min_lat"] + shrink, b["max_lon"] - shrink, b["max_lat"] - shrink
    ring = F.array(*(G.point(x, y) for x, y in ((w, s), (e, s), (e, n), (w, n), (w, s))))
    return regions.select("id", ring.alias("coords"), F.create_map(F.lit("natural"), F.lit("sea"), F.lit("layer"), F.lit("-5")).alias("tags"))
