"""Writing an intermediate table where all executors can read it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
#: Spark's setting that removes a query's shuffle files when the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting for how much larger than its file a table is. Two whole numbers, 70 bytes or more in a broadcast, can be less than two in a file.
FACTOR, PACKED = "spark.sql.sources.fileCompressionFactor", "50.0"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset, a new folder on a single machine, and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not found and app not in _own:
        _own[app] = "file:" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return (found or _own[app]).rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: a loop's plan stays short, and a lost executor costs its own tasks only.

    What was shuffled for the write goes when it is done. A written table is taken for ``PACKED`` times its file, so
    that what is broadcast is bounded: a file of 200 kB at most, which has been up to 50 MB."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    own = {CLEANUP: "true", FACTOR: PACKED}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete what :func:`stage` wrote, once nothing will read it again."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def join_skewed(rows: DataFrame, table: DataFrame, key: str, many: int = 200_000) -> DataFrame:
    """``rows`` joined with ``table``, whose ``key`` is unique, where few keys may have very many of the (written) rows.

    What belongs to these keys, at most one in ``many`` rows, is broadcast; the rest is shuffled.
    """
    from pyspark.sql import functions as F

    heavy = stage(rows.groupBy(key).count().where(F.col("count") > many).select(key), "heavy-keys")
    light = rows.join(F.broadcast(heavy), key, "left_anti").join(table, key)
    if heavy.isEmpty():
        return light
    return light.unionByName(rows.join(F.broadcast(table.join(F.broadcast(heavy), key, "left_semi")), key))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of an edge.

    Labels spread over the edges and are shortened to their label's label, until no edge has two; every round is a
    join and an aggregate, so a large component is never gathered. Labels without such an edge are whole components:
    where most rows are of these, the rest goes on alone.
    """
    from functools import reduce

    from pyspark.sql import functions as F

    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).union(edges.select(F.col(b), F.col(a))).where("u IS NOT NULL AND v IS NOT NULL").distinct()
    both = stage(both, "edges")
    label = stage(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.min("u")).alias("component")), "labels")
    whole = []
    while True:
        near = both.join(label, both.v == label.node).groupBy("u").agg(F.min("component").alias("c"), F.max("component").alias("most"))
        spread = label.join(near, label.node == near.u).selectExpr("node", "least(component, c) AS component", "component AS was", "c <> component OR most <> component AS crossed")
        up = label.select(F.col("node").alias("component"), F.col("component").alias("up"))
        after = stage(spread.join(up, "component").select("node", F.least("component", "up").alias("component"), "was", "crossed"), "labels")
        unstage(label)
        n, crossed = after.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("crossed").cast("int")), F.lit(0))).first()
        label = after.select("node", "component")
        if not crossed:
            unstage(both)
            return reduce(DataFrame.union, whole, label)
        if 2 * crossed < n:
            open_ = after.where("crossed").select("was").distinct()
            whole.append(stage(after.join(open_, "was", "left_anti").select("node", "component"), "components"))
            label = stage(after.join(open_, "was", "left_semi").select("node", "component"), "labels")
            rest = stage(both.join(label.select(F.col("node").alias("u")), "u", "left_semi"), "edges")
            unstage(after)
            unstage(both)
            both = rest
