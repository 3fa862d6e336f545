"""The lens: map entities read from the given tables, one SELECT each, the same text for Spark SQL and other engines."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events".split()

LENS: dict[str, str] = {
    "osm_node": """
SELECT p_partkey AS id,
       CAST(14.0 AS DOUBLE) + (p_partkey % 50) * CAST(0.002 AS DOUBLE) AS lon,
       CAST(50.0 AS DOUBLE) + floor(p_partkey / 50) * CAST(0.002 AS DOUBLE) AS lat
FROM part
""",
    "way_node": """
SELECT way_id, CAST(row_number() OVER (PARTITION BY way_id ORDER BY k, ref) AS BIGINT) AS seq, ref
FROM (
  SELECT l_orderkey AS way_id, l_linenumber AS k, l_partkey AS ref FROM lineitem
) w
""",
    "way_info": """
SELECT o_orderkey AS id,
       concat('Street ', CAST(o_custkey % 97 AS VARCHAR(10))) AS name,
       CASE WHEN o_orderstatus = 'F' THEN 'residential'
            WHEN o_orderstatus = 'O' THEN 'track' ELSE 'platform' END AS highway,
       o_orderpriority AS surface
FROM orders
""",
    "member": """
SELECT o_custkey AS rel_id, 'way' AS type, o_orderkey AS ref,
       CASE WHEN o_orderstatus = 'F' THEN 'outer'
            WHEN o_orderstatus = 'O' THEN 'street' ELSE 'inner' END AS role
FROM orders
UNION ALL
SELECT o_custkey - o_custkey % 10 AS rel_id, 'way' AS type, o_orderkey AS ref, 'street' AS role
FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey % 10 > 0
UNION ALL
SELECT CAST(floor(c_custkey / 10) AS BIGINT) AS rel_id, 'relation' AS type, c_custkey AS ref, 'child' AS role
FROM customer WHERE c_custkey > 0
""",
    "rel_info": """
SELECT c_custkey AS id, c_name AS name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'hiking'
            WHEN c_mktsegment = 'AUTOMOBILE' THEN 'bicycle'
            WHEN c_mktsegment = 'MACHINERY' THEN 'ski'
            WHEN c_mktsegment = 'FURNITURE' THEN 'mtb' ELSE 'bus' END AS route,
       CASE WHEN c_nationkey % 3 = 0 THEN 'lwn' WHEN c_nationkey % 3 = 1 THEN 'rcn' ELSE '' END AS network,
       CASE WHEN c_nationkey % 4 = 0 THEN 'red:white:red_bar'
            WHEN c_nationkey % 4 = 1 THEN 'blue:white:blue_bar:E8:black'
            WHEN c_nationkey % 4 = 2 THEN 'green' ELSE '' END AS osmc_symbol
FROM customer
""",
    "place": """
SELECT s_suppkey AS id, s_name AS name, (s_nationkey % 6) + 1 AS type_code,
       CAST(floor(abs(s_acctbal) * 100) AS BIGINT) AS population,
       CAST(14.0 AS DOUBLE) + (s_suppkey % 10) * CAST(0.01 AS DOUBLE) + CAST(0.0051 AS DOUBLE) AS lon,
       CAST(50.0 AS DOUBLE) + (floor(s_suppkey / 10) % 10) * CAST(0.008 AS DOUBLE) + CAST(0.0043 AS DOUBLE) AS lat
FROM supplier
""",
    "boundary_ring": """
SELECT n_nationkey AS id, n_name AS name, 4 + n_nationkey % 7 AS admin_level, q.seq,
       CAST(14.0 AS DOUBLE) + (n_nationkey % 5 + q.dx) * CAST(0.02 AS DOUBLE) AS lon,
       CAST(50.0 AS DOUBLE) + (floor(n_nationkey / 5) + q.dy) * CAST(0.016 AS DOUBLE) AS lat
FROM nation CROSS JOIN (VALUES (0, 0, 0), (1, 0, 1), (2, 1, 1), (3, 1, 0), (4, 0, 0)) AS q(seq, dx, dy)
""",
    # Slanted shapes: a part with a hole, and a second one.
    "shape_ring": """
SELECT n_nationkey AS id, q.part, q.ring, q.seq,
       CAST(14.0 AS DOUBLE) + (n_nationkey % 5) * CAST(0.02 AS DOUBLE) + q.dx * CAST(0.001 AS DOUBLE) AS lon,
       CAST(50.0 AS DOUBLE) + floor(n_nationkey / 5) * CAST(0.016 AS DOUBLE) + q.dy * CAST(0.001 AS DOUBLE) AS lat
FROM nation CROSS JOIN (VALUES (0, 0, 0, 10, -3), (0, 0, 1, 27, 7), (0, 0, 2, 11, 19), (0, 0, 3, -5, 8), (0, 0, 4, 10, -3),
  (0, 1, 0, 8, 4), (0, 1, 1, 13, 6), (0, 1, 2, 9, 11), (0, 1, 3, 8, 4), (1, 0, 0, 30, 1), (1, 0, 1, 36, 3), (1, 0, 2, 31, 15), (1, 0, 3, 30, 1)) AS q(part, ring, seq, dx, dy)
""",
    "house": """
SELECT c_custkey AS id, CAST(k % 40 AS VARCHAR(10)) AS number,
       CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat('Street ', CAST(c_custkey % 97 AS VARCHAR(10))) END AS street,
       CAST(14.0 AS DOUBLE) + (k % 499) * CAST(0.0002 AS DOUBLE) AS lon,
       CAST(50.0 AS DOUBLE) + (k % 397) * CAST(0.0002 AS DOUBLE) AS lat,
       c_nationkey AS postcode
FROM (
  SELECT c_custkey, c_nationkey,
         CASE WHEN c_custkey % 25 = 1 THEN c_custkey - 1 ELSE c_custkey END AS k
  FROM customer
) c
""",
    "poi_tag_long": """
SELECT p_partkey AS id, 'brand' AS k, p_brand AS v FROM part
UNION ALL SELECT p_partkey, 'amenity', lower(p_type) FROM part
UNION ALL SELECT p_partkey, 'name', p_name FROM part
UNION ALL SELECT p_partkey, 'phone', CAST(p_size AS VARCHAR(10)) FROM part WHERE p_size % 2 = 0
""",
    "change_feed": """
SELECT user_id AS id, event_id AS version, ts,
       CASE WHEN event_type = 'error' THEN 'delete'
            WHEN event_type = 'signup' THEN 'create' ELSE 'modify' END AS action
FROM events
""",
}


def lens(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view of the lens over the Parquet tables in ``sf_dir``; no name is registered."""
    return select(spark, sf_dir, LENS[name])


def select(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A SELECT whose FROM clauses name given tables, over the Parquet files in ``sf_dir``."""
    tables = "|".join(TABLES)
    return spark.sql(re.sub(rf"\bFROM ({tables})\b", lambda m: f"FROM parquet.`{sf_dir}/{m[1]}.parquet` AS {m[1]}", sql))


def with_lens(sql: str, *names: str) -> str:
    """``sql`` with the named views as common table expressions, for an engine that has the given tables."""
    views = ",\n".join(f"{n} AS ({LENS[n].strip()})" for n in names)
    head = "WITH RECURSIVE " if "-- recursive" in sql else "WITH "
    rest = sql.replace("-- recursive", "").strip()
    if rest.upper().startswith("WITH "):
        rest = ", " + rest[5:]
    return f"{head}{views}\n{rest}"
