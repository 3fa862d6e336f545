"""Entity tables: resolving references, closures, set operations, snapshots."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrane.functions import tags as T
from terrane.operators.shared import stage


class Entities(NamedTuple):
    node: DataFrame
    way: DataFrame
    relation: DataFrame


def load_entities(spark: SparkSession, path: str) -> Entities:
    """The three tables of a folder; filters on them reach the Parquet scans."""
    return Entities(*(spark.read.parquet(f"{path}/{t}.parquet") for t in Entities._fields))


def address_entities(e: Entities) -> Entities:
    """All nodes, ways that are not only planned, and relations that can tell an address."""
    return Entities(e.node, e.way.where(T.address_way(F.col("tags"))), e.relation.where(T.address_relation(F.col("tags"))))


def country_entities(e: Entities) -> Entities:
    """Continent nodes, ways and relations of country borders, and what these refer to."""
    kept = Entities(e.node.where(T.is_continent(F.col("tags"))), e.way.where(T.country_entity(F.col("tags"))), e.relation.where(T.country_entity(F.col("tags"))))
    return complete(e, kept)


def tags_filter(e: Entities, expressions: list[str], with_references: bool = True) -> Entities:
    """Entities that match any expression, and what they refer to."""
    kept = Entities(*(df.where(T.tags_match(F.col("tags"), expressions, kind)) for df, kind in zip(e, "nwr", strict=True)))
    return complete(e, kept) if with_references else kept


def way_nodes(way: DataFrame) -> DataFrame:
    """``way_id, seq, ref`` of ways with an array of references; ``seq`` from 1."""
    return way.select(F.col("id").alias("way_id"), F.posexplode("refs").alias("_p", "ref")).select("way_id", (F.col("_p") + 1).cast("bigint").alias("seq"), "ref")


def resolve_way_points(way_node: DataFrame, node: DataFrame) -> DataFrame:
    """``way_id, seq, lon, lat``; references to nodes that are missing are left out."""
    return way_node.join(node.select(F.col("id").alias("ref"), "lon", "lat"), "ref").select("way_id", "seq", "ref", "lon", "lat")


def resolve_ways(way_node: DataFrame, node: DataFrame) -> DataFrame:
    """``id, coords`` of ways with more than one node that exists, in order."""
    points = resolve_way_points(way_node, node)
    lines = points.groupBy(F.col("way_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("seq", "lon", "lat"))).alias("p"))
    return lines.where(F.size("p") > 1).select("id", F.transform("p", lambda x: F.struct(x["lon"].alias("lon"), x["lat"].alias("lat"))).alias("coords"))


def members(relation: DataFrame) -> DataFrame:
    """``rel_id, seq, type, ref, role``."""
    return relation.select(F.col("id").alias("rel_id"), F.posexplode("members").alias("seq", "m")).select("rel_id", "seq", "m.type", "m.ref", "m.role")


def resolve_members(member: DataFrame, way: DataFrame) -> DataFrame:
    """Way members with their geometry (``id, coords``); members that are missing are left out."""
    return member.where("type = 'way'").join(way.select(F.col("id").alias("ref"), "coords"), "ref")


def reach(start: DataFrame, steps: DataFrame, *keys: str, max_depth: int = 64) -> DataFrame:
    """``*keys, id``: the start (``*keys, id``) and all that is reached from it by steps ``_from, _to``.

    A round follows only what was new in the one before, and a row is followed once, so cycles end and the work is that
    of what is reached.
    """
    cols = [*keys, "id"]
    front = seen = stage(start.select(*cols).distinct(), "reach")
    steps = steps.select("_from", "_to").distinct()
    for _ in range(max_depth):
        ahead = front.join(steps, front.id == steps["_from"]).select(*keys, F.col("_to").alias("id")).distinct()
        front = stage(ahead.join(seen, cols, "left_anti"), "reach")
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def expand_relations(member: DataFrame, max_depth: int = 32, roots: DataFrame | None = None) -> DataFrame:
    """``root, rel_id, depth``: every relation reached from each root through relation members, the root at depth 0.

    ``roots`` (``id``) are all relations with members if none are given. A step is one join over the frontier. A path stops where it would meet a relation that it holds already, so a
    cycle ends; ``depth`` is the least one. ``max_depth`` only guards against broken data.
    """
    child = member.where("type = 'relation'").select(F.col("rel_id").alias("_from"), F.col("ref").alias("_to")).distinct()
    first = member.select(F.col("rel_id").alias("root")).distinct()
    if roots is not None:
        first = first.join(roots.select(F.col("id").alias("root")).distinct(), "root", "left_semi")
    front = first.select("root", F.col("root").alias("rel_id"), F.lit(0).alias("depth"))
    seen = stage(front, "expand")
    front = seen
    for depth in range(1, max_depth + 1):
        step = front.join(child, front.rel_id == child["_from"]).select("root", F.col("_to").alias("rel_id"), F.lit(depth).alias("depth")).distinct()
        # What the root has reached before is not followed again: its further members were reached then too.
        front = stage(step.join(seen.select("root", "rel_id"), ["root", "rel_id"], "left_anti"), "expand")
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def complete(e: Entities, kept: Entities) -> Entities:
    """``kept`` with all that it refers to: relations of relations, ways of these, nodes of all."""
    all_members = members(e.relation)
    down = all_members.where("type = 'relation'").select(F.col("rel_id").alias("_from"), F.col("ref").alias("_to"))
    relations = reach(kept.relation.select("id"), down)
    own = all_members.join(relations.withColumnRenamed("id", "rel_id"), "rel_id", "left_semi")
    ways = own.where("type = 'way'").select(F.col("ref").alias("id")).union(kept.way.select("id")).distinct()
    way = e.way.join(ways, "id", "left_semi")
    nodes = way.select(F.explode("refs").alias("id")).union(own.where("type = 'node'").select("ref")).union(kept.node.select("id")).distinct()
    return Entities(e.node.join(nodes, "id", "left_semi"), way, e.relation.join(relations, "id", "left_semi"))


def nodes_by_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows by a list ``pos, id``, in its order and with its repeats; ids that are missing are left out.

    Where positions repeat, as in a list of many ways, ids part the ranges that are sorted.
    """
    return ids.join(df, "id").orderBy("pos", "id")


def contains_id(df: DataFrame, entity_id: int) -> bool:
    return not df.where(F.col("id") == entity_id).limit(1).isEmpty()


def merge_entities(*tables: DataFrame) -> DataFrame:
    """A union in which the same version of an entity occurs once. Columns ``type, id, version`` and any others."""
    return union_all(*tables).dropDuplicates(["type", "id", "version"])


def union_all(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def distinct_ids(df: DataFrame, key: str = "id") -> DataFrame:
    return df.select(key).distinct()


def without(df: DataFrame, seen: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not among ``seen``."""
    return df.join(seen.select(key).distinct(), key, "left_anti")


def sort_entities(df: DataFrame) -> DataFrame:
    """Nodes, ways, relations; by id. Ranges are sorted in parallel."""
    rank = F.when(F.col("type") == "node", 0).when(F.col("type") == "way", 1).otherwise(2)
    return df.withColumn("_rank", rank).orderBy("_rank", "id").drop("_rank")


def latest(changes: DataFrame, keys: list[str] = ["type", "id"]) -> DataFrame:  # noqa: B006
    """The last change of each entity, by version and then time. A sum over rows, so no entity is gathered in a task."""
    rest = [c for c in changes.columns if c not in keys]
    order = F.struct("version", "ts", *(c for c in rest if c not in ("version", "ts")))
    return changes.groupBy(*keys).agg(F.max(order).alias("_last")).select(*keys, *(F.col("_last")[c].alias(c) for c in rest))


def apply_changes(snapshot: DataFrame, changes: DataFrame, keys: list[str] = ["type", "id"]) -> DataFrame:  # noqa: B006
    """The snapshot after the changes: each entity's last version, without those deleted last."""
    return latest(union_all(snapshot.withColumn("action", F.lit("create")) if "action" not in snapshot.columns else snapshot, changes), keys).where("action <> 'delete'")


def is_stale(ts, now, days: int):
    """Older than so many days."""
    return F.col(ts) < F.lit(now) - F.expr(f"INTERVAL {days} DAYS")


def with_seq(df: DataFrame, order: list[str], start: int = 0, name: str = "seq") -> DataFrame:
    """Numbers from ``start`` in the given order, without one task for all rows.

    Rows are sorted by ranges; each range's rows are counted, and a range starts where those before it end.
    """
    ranged = stage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "seq")
    # One row a range: as many as there were tasks.
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", "_first", before.alias("_before"))
    return ranged.join(starts, "_part").withColumn(name, (F.col("_at") - F.col("_first") + F.col("_before") + start).cast("bigint")).drop("_part", "_at", "_first", "_before")


def dictionary(df: DataFrame, column: str, start: int = 1) -> DataFrame:
    """``id, value``: the distinct non-empty values, numbered by value from ``start``."""
    return with_seq(df.select(F.col(column).alias("value")).where(F.col(column) != "").distinct(), ["value"], start, "id").select("id", "value")


def dictionary_ids(df: DataFrame, column: str, words: DataFrame, name: str) -> DataFrame:
    """``df`` with the number of its value; -1 for an empty or unknown one."""
    return df.join(words.select(F.col("id").alias(name), F.col("value").alias(column)), column, "left").fillna(-1, [name])


def tag_usage(tags_long: DataFrame, used: list[str]) -> DataFrame:
    """``key, n, used`` of all keys of a long tag table ``k``."""
    return tags_long.groupBy(F.col("k").alias("key")).agg(F.count(F.lit(1)).alias("n")).withColumn("used", F.col("key").isin(*used))
