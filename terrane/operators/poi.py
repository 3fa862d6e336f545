"""Points of interest as a star of tables, by rules that are data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.operators.entities import dictionary


def match_poi_rules(tags_long: DataFrame, rules: DataFrame, kind: str | None = None) -> DataFrame:
    """``id, root, sub`` of entities that a rule accepts: its key and value occur, and any of its filters passes.

    ``tags_long`` is ``id, k, v``; with ``kind`` only rules of that entity kind count. A filter is a key and a list of
    values, where ``~`` is for the key's absence and ``*`` for any value; a rule without filters always passes. Rules
    are joined by key and value, as few or as many as there are.
    """
    r = rules if kind is None else rules.where(F.col("kind") == kind)
    rule_id = F.monotonically_increasing_id()
    # Rules that differ in their filters only are rules of their own: any of them may pass.
    r = r.select("key", "value", "root", "sub", "filters")
    hit = tags_long.join(r, (F.col("k") == F.col("key")) & (F.col("v") == F.col("value"))).select("id", "root", "sub", "filters").withColumn("_r", rule_id)
    free = hit.where(F.coalesce(F.size("filters"), F.lit(0)) <= 0).select("id", "root", "sub")
    asked = hit.where(F.size("filters") > 0).select("id", "root", "sub", "_r", F.explode("filters").alias("fk", "fv"))
    own = tags_long.select("id", F.col("k").alias("fk"), F.col("v").alias("own"))
    passed = asked.join(own, ["id", "fk"], "left").where(
        F.when(F.col("own").isNull(), F.array_contains("fv", "~")).otherwise(F.array_contains("fv", "*") | F.array_contains("fv", F.col("own")))
    )
    return free.union(passed.select("id", "root", "sub")).distinct()


def multi_values(tags_long: DataFrame, separator: str = "|") -> DataFrame:
    """``id, k, v`` with the repeated values of a key joined, in order."""
    return tags_long.groupBy("id", "k").agg(F.array_join(F.array_sort(F.collect_list("v")), separator).alias("v"))


def eav(tags_long: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Key dictionary, value dictionary, and ``poi_id, key_id, value_id``."""
    keys, values = dictionary(tags_long, "k"), dictionary(tags_long, "v")
    rows = tags_long.join(keys.select(F.col("id").alias("key_id"), F.col("value").alias("k")), "k").join(values.select(F.col("id").alias("value_id"), F.col("value").alias("v")), "v")
    return keys, values, rows.select(F.col("id").alias("poi_id"), "key_id", "value_id")


def build_poi(points: DataFrame, tags_long: DataFrame, rules: DataFrame, kind: str | None = None) -> dict[str, DataFrame]:
    """The star: points, folders, keys, values and the bridges. ``points`` is ``id, lon, lat``; rules are those of ``kind``, if given."""
    found = match_poi_rules(tags_long, rules, kind)
    ids = found.select("id").distinct()
    own = multi_values(tags_long.join(ids, "id", "left_semi").withColumn("k", F.lower("k")).where("v <> ''"))
    pick = lambda k: own.where(F.col("k") == k).select("id", F.col("v").alias(k.replace(":", "_")))
    named = ids.join(pick("name"), "id", "left").join(pick("name:en"), "id", "left").select("id", F.coalesce("name", "name_en").alias("name"))
    roots, subs = dictionary(found, "root"), dictionary(found, "sub")
    bridge = found.join(roots.select(F.col("id").alias("root_id"), F.col("value").alias("root")), "root").join(subs.select(F.col("id").alias("sub_id"), F.col("value").alias("sub")), "sub")
    keys, values, rows = eav(own.where("k NOT IN ('name', 'name:en')"))
    return {
        "point": points.join(named, "id").select("id", "name", "lon", "lat"),
        "folder_root": roots,
        "folder_sub": subs,
        "tag_key": keys,
        "tag_value": values,
        "poi_folder": bridge.select(F.col("id").alias("poi_id"), "root_id", "sub_id"),
        "poi_tag": rows,
    }
