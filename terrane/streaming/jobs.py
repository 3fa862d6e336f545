"""The two jobs with a natural streaming form: keeping a snapshot current, and daily usage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrane.operators.entities import apply_changes, latest, union_all


#: Buckets of a snapshot: a batch rewrites those that its entities fall in, so there should be many more than a batch touches.
BUCKETS = 256


def stream_changes(changes: DataFrame, snapshot_path: str, checkpoint: str, keys: list[str] = ["type", "id"], buckets: int = BUCKETS) -> StreamingQuery:  # noqa: B006
    """Keep the last change of each entity under ``snapshot_path`` by :func:`merge_batch`. Read the result with :func:`snapshot`."""
    merge = lambda batch, n: merge_batch(batch, n, snapshot_path, keys, buckets)
    return changes.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_batch(batch: DataFrame, n: int, snapshot_path: str, keys: list[str] = ["type", "id"], buckets: int = BUCKETS) -> None:  # noqa: B006
    """Bring the changes of batch ``n`` (0, 1, …) into the snapshot; cost follows the buckets that they touch.

    Entities are dealt to buckets by a hash of their keys. ``manifest/batch=n`` says which batch wrote each bucket last:
    a batch reads the touched buckets, writes them anew under its own number, and then its manifest. A batch that is run
    again starts from the manifest before it and writes the same. The last changes are kept with their action, so that a
    late older change cannot bring a deleted entity back. What no manifest but older ones than the last two names is deleted.
    """
    spark = batch.sparkSession
    changed = f"{snapshot_path}/change"
    latest(batch, keys).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).write.mode("overwrite").parquet(changed)
    now = spark.read.parquet(changed)
    # As many rows as there are buckets, at most.
    touched = {r["bucket"] for r in now.select("bucket").distinct().collect()}
    before = _manifest(spark, snapshot_path, n - 1)
    held = sorted(b for b in touched if b in before)
    if held:
        now = latest(union_all(_read(spark, snapshot_path, {b: before[b] for b in held}), now), ["bucket", *keys])
    now.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{snapshot_path}/data/batch={n}")
    rows = sorted((before | dict.fromkeys(touched, n)).items())
    spark.createDataFrame(rows, "bucket int, written int").coalesce(1).write.mode("overwrite").parquet(f"{snapshot_path}/manifest/batch={n}")
    jvm = spark._jvm
    for bucket, written in _manifest(spark, snapshot_path, n - 2).items():
        if before.get(bucket) != written:
            path = jvm.org.apache.hadoop.fs.Path(f"{snapshot_path}/data/batch={written}/bucket={bucket}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _manifest(spark: SparkSession, snapshot_path: str, n: int) -> dict[int, int]:
    """By bucket the batch that wrote it, after batch ``n``."""
    if n < 0:
        return {}
    return {r["bucket"]: r["written"] for r in spark.read.parquet(f"{snapshot_path}/manifest/batch={n}").collect()}


def _read(spark: SparkSession, snapshot_path: str, buckets: dict[int, int]) -> DataFrame:
    paths = [f"{snapshot_path}/data/batch={n}/bucket={b}" for b, n in sorted(buckets.items())]
    return spark.read.option("basePath", f"{snapshot_path}/data").parquet(*paths).drop("batch")


def snapshot(spark: SparkSession, snapshot_path: str) -> DataFrame:
    """The entities after the last batch."""
    last = spark.read.parquet(f"{snapshot_path}/manifest").agg(F.max("batch")).first()[0]
    return _read(spark, snapshot_path, _manifest(spark, snapshot_path, last)).drop("bucket").where("action <> 'delete'")


def stream_usage(events: DataFrame, item: str = "event_type", delay: str = "1 day") -> DataFrame:
    """``date, item, n``: events a day and item; a day is closed when the watermark has passed it."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return timed.groupBy(F.window("ts", "1 day"), F.col(item).alias("item")).agg(F.count(F.lit(1)).alias("n")).select(F.to_date("window.start").alias("date"), "item", "n")


__all__ = ["apply_changes", "merge_batch", "snapshot", "stream_changes", "stream_usage"]
