"""Readers of entity files that are not Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_TAG = "tag array<struct<_k:string,_v:string>>"
_KINDS = {
    "node": f"_id bigint, _lon double, _lat double, {_TAG}",
    "way": f"_id bigint, nd array<struct<_ref:bigint>>, {_TAG}",
    "relation": f"_id bigint, member array<struct<_type:string,_ref:bigint,_role:string>>, {_TAG}",
}


def read_osm_xml(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Nodes, ways or relations of XML files, in the entity schema. Files are split between tasks by element."""
    raw = spark.read.format("xml").option("rowTag", kind).schema(_KINDS[kind]).load(path)
    none = F.array().cast("array<struct<_k:string,_v:string>>")
    tags = F.map_from_entries(F.transform(F.coalesce("tag", none), lambda t: F.struct(t["_k"].alias("key"), F.coalesce(t["_v"], F.lit("")).alias("value"))))
    own = {
        "node": [F.col("_lon").alias("lon"), F.col("_lat").alias("lat")],
        "way": [F.transform(F.coalesce("nd", F.array().cast("array<struct<_ref:bigint>>")), lambda n: n["_ref"]).alias("refs")] if kind == "way" else [],
        "relation": [F.transform(F.coalesce("member", F.array().cast("array<struct<_type:string,_ref:bigint,_role:string>>")), lambda m: F.struct(m["_type"].alias("type"), m["_ref"].alias("ref"), m["_role"].alias("role"))).alias("members")] if kind == "relation" else [],
    }[kind]
    return raw.select(F.col("_id").alias("id"), *own, tags.alias("tags"))


def read_poly(spark: SparkSession, path: str) -> DataFrame:
    """``file, geom`` of ``.poly`` text files: a multi-polygon each.

    The first line names the file's polygon; a section begins with its name, ``!`` before it for a hole, lists a point a
    line and ends with END. Open rings are closed. A hole belongs to the outer ring before it.
    """
    whole = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.poly)?$", 1).alias("file"), "value")
    lines = whole.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("n", "line")).withColumn("line", F.trim("line")).where("n > 0 AND line <> ''")
    w = Window.partitionBy("file").orderBy("n")
    ends = F.coalesce(F.sum(F.when(F.col("line") == "END", 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sections = lines.withColumn("section", ends).where("line <> 'END'")
    head = F.first("line").over(Window.partitionBy("file", "section").orderBy("n"))
    points = sections.withColumn("head", head).where("line <> head OR line RLIKE '^[-+0-9.]+[ \\t]'").withColumn("xy", F.split("line", r"\s+")).where("size(xy) = 2")
    ring = points.groupBy("file", "section", "head").agg(F.array_sort(F.collect_list(F.struct("n", F.element_at("xy", 1).cast("double").alias("lon"), F.element_at("xy", 2).cast("double").alias("lat")))).alias("r"))
    ring = ring.select("file", "section", F.col("head").startswith("!").alias("hole"), F.transform("r", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))).alias("ring"))
    from terrane.functions.geo import close_ring

    ring = ring.withColumn("ring", close_ring(F.col("ring")))
    part = F.sum(F.when(~F.col("hole"), 1).otherwise(0)).over(Window.partitionBy("file").orderBy("section"))
    polygons = ring.withColumn("part", part).groupBy("file", "part").agg(
        F.first(F.when(~F.col("hole"), F.col("ring")), ignorenulls=True).alias("outer"), F.transform(F.array_sort(F.collect_list(F.when(F.col("hole"), F.struct("section", "ring")))), lambda x: x["ring"]).alias("holes")
    )
    return polygons.where("outer IS NOT NULL").groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("part", F.struct("outer", "holes").alias("p")))), lambda x: x["p"]).alias("geom"))
