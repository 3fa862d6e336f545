"""Tables that are small only as files are not broadcast."""

from pyspark.sql import functions as F

from terrane.operators import shared


def test_many_rows_in_a_small_file_do_not_go_through_the_driver(spark, monkeypatch):
    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    n = 400_000
    rows = shared.stage(spark.range(n).select("id", F.floor(F.col("id") / 1000).alias("k")), "rows")
    before = spark.conf.get(shared.FACTOR, None)
    out = shared.stage(rows.alias("a").join(rows.alias("b"), "id").select("id", "a.k"), "joined")
    assert out.count() == n and spark.conf.get(shared.FACTOR, None) == before
    # The plan as it is made while it is written.
    spark.conf.set(shared.FACTOR, shared.PACKED)
    try:
        seen(rows.alias("a").join(rows.alias("b"), "id"))
        seen(rows.join(rows.groupBy("k").agg(F.min("id").alias("least")).where("k < 0"), "k"))
    finally:
        spark.conf.unset(shared.FACTOR) if before is None else spark.conf.set(shared.FACTOR, before)
    assert all("BroadcastHashJoin" not in p and "SortMergeJoin" in p for p in plans)


def test_what_components_broadcast_is_small(spark):
    """By Spark's own count of what went to the driver."""
    store = spark._jsparkSession.sharedState().statusStore()
    first = store.executionsCount()
    n = 300_000
    edges = spark.range(n).select((F.col("id") * 2).alias("a"), (F.col("id") * 2 + 1).alias("b"))
    assert shared.components(edges, "a", "b").select("component").distinct().count() == n
    sizes = []
    for e in range(first, store.executionsCount()):
        graph = store.execution(e)
        if graph.isEmpty():
            continue
        it = store.planGraph(e).allNodes().iterator()
        metrics = store.executionMetrics(e)
        while it.hasNext():
            node = it.next()
            if node.name().startswith("BroadcastExchange"):
                m = node.metrics().iterator()
                while m.hasNext():
                    x = m.next()
                    value = metrics.get(x.accumulatorId())
                    if x.name() == "data size" and value.isDefined():
                        sizes.append(value.get())
    assert not [s for s in sizes if "MiB" in s and float(s.split()[0]) > 10], sizes


def test_whole_components_do_not_go_through_later_rounds(spark, monkeypatch):
    """A long chain needs many rounds, a thousand pairs beside it do not."""
    staged = []
    monkeypatch.setattr(shared, "stage", lambda df, name, own=shared.stage: (out := own(df, name), staged.append((name, out.count())))[0])
    pairs = [(10_000 + 2 * i, 10_001 + 2 * i) for i in range(1000)]
    chain = [((37 * i) % 101, (37 * (i + 1)) % 101) for i in range(100)]
    loose = [(50_000, 50_000), (60_002, 60_001), (60_001, 60_003), (None, 3)]
    got = {r.node: r.component for r in shared.components(spark.createDataFrame(pairs + chain + loose, "a long, b long"), "a", "b").collect()}
    want = {x: p[0] for p in pairs for x in p} | {i: 0 for i in range(101)} | {50_000: 50_000, 60_001: 60_001, 60_002: 60_001, 60_003: 60_001}
    assert got == want
    sizes = [n for name, n in staged if name == "labels"]
    assert len(sizes) > 4 and sizes[0] == len(want) and max(sizes[3:]) <= 101
