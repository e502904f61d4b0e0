"""Streaming pieces: memory sink, null-typed rows, SQL-registered exact functions."""

from pyspark.sql import functions as F

from tidepool.functions import exact as X
from tidepool.sources import sinks
from tidepool.streaming import state


def test_delta_stream_to_memory_sink(spark):
    rows = [("a", 0, "1", "1", 0), ("b", 1, "1", "1", 5), ("a", 2, "0.5", "2", 1),
            ("b", 3, "0.5", "2", 2), ("a", 4, "1", "1", 0)]
    df = spark.createDataFrame(rows, "address string, logId long, price0 string, price1 string, tick long")
    src = sinks.scratch_path(spark, "t-mem-src")
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    q = state.start(state.swap_delta_stream(stream, expiry=10000).writeStream.format("memory")
                    .queryName("delta_mem").outputMode("append"), live=False)
    got = {r["logId"]: r for r in spark.table("delta_mem").collect()}
    assert q is not None and got[0]["priceDelta0"] is None
    assert (got[2]["priceDelta0"], got[2]["priceDeltaPct1"], got[2]["tickDelta"]) == ("-5e1b0/1e0b0", 100.0, 1)
    assert (got[3]["tickDelta"], got[4]["priceDeltaPct0"]) == (-3, 100.0)


def test_exchange_rate_row_nulls(spark):
    df = spark.createDataFrame([(10, "a")], "blockNumber long, address string")
    out = state.to_exchange_rate_row(df)
    r = out.first()
    assert r["base0"] is None and r["priceDeltaPct0"] is None
    assert dict(out.dtypes)["usdBase"].startswith("struct<poolAddress:string")
    assert r["blockNumberTs"].timestamp() == 11


def test_sql_registered_exact_functions(spark):
    X.register(spark)
    r = spark.sql("SELECT exact_mul('1', '2') AS m, exact_text(exact_div('6', '5')) AS t").first()
    assert (r["m"], r["t"]) == ("2e0b0/1e0b0", "1.2")


def _interleaved(spark, root, batches):
    def rate(rows):
        from pyspark.sql import Window
        w = Window.partitionBy("address").orderBy("logId")
        return rows.withColumn("before", F.lag("logId").over(w))
    s = state.RatedStream(spark, rate=rate, is_quote=F.lit(False), is_usd_quote=F.lit(False), quote_key="address",
                          target=f"{root}/out", root=root, expiry=100, upsert_keys=("date", "logId"))
    for k, rows in batches:
        s.process(spark.createDataFrame([("2024-01-01", *r) for r in rows], "date string, address string, logId long"), k)
    return {r["logId"]: r["before"] for r in spark.read.parquet(f"{root}/out").collect()}


def test_pools_may_interleave_over_batches(spark):
    root = sinks.scratch_path(spark, "t-interleave")
    got = _interleaved(spark, root, [(0, [("a", 1), ("a", 3), ("a", 9)]), (1, [("b", 2), ("b", 4), ("a", 10), ("a", 5)])])
    assert got == {1: None, 3: 1, 9: 3, 2: None, 4: 2, 10: 9}
    assert [(r["address"], r["logId"]) for r in spark.read.parquet(f"{root}/rejected").collect()] == [("a", 5)]


def test_missing_state_fails(spark):
    import pytest
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        _interleaved(spark, sinks.scratch_path(spark, "t-lost"), [(3, [("a", 1)])])


def test_delta_keeps_the_fraction_of_the_order_key(spark):
    df = spark.createDataFrame([("a", "5.0000100002", "1", "1", 0), ("a", "5.0000100007", "2", "0.5", 1)],
                               "address string, logId string, price0 string, price1 string, tick long").withColumn("logId", F.col("logId").cast("decimal(38,18)"))
    src = sinks.scratch_path(spark, "t-fraction")
    df.coalesce(1).write.parquet(src)
    state.start(state.swap_delta_stream(spark.readStream.schema(df.schema).parquet(src), expiry=10).writeStream.format("memory")
                .queryName("delta_fraction").outputMode("append"), live=False)
    got = sorted((str(r["logId"]), r["tickDelta"], r["late"]) for r in spark.table("delta_fraction").collect())
    assert [x[1:] for x in got] == [(None, False), (1, False)] and got[0][0] != got[1][0]


def test_a_batch_leaves_its_output_and_state_alone(spark):
    """Rows published, rated in steps and merged: what was staged on the way goes."""
    import os

    def scratch():
        top = sinks.checkpoint_dir(spark).removeprefix("file://")
        names = [n for n in os.listdir(top) if n.startswith(("publish-stage", "rated-batch"))]
        return sorted(names), sorted(os.listdir(f"{top}/upsert-stage")) if os.path.exists(f"{top}/upsert-stage") else []
    root, before = sinks.scratch_path(spark, "t-steps"), scratch()
    rows = spark.range(40).select(F.lit("2024-01-01").alias("date"), F.concat(F.lit("A"), F.col("id") % 2).alias("address"), F.col("id").alias("logId"))
    sinks.publish_in_order(rows, f"{root}/log", batches=2, files=2)
    published = sinks.read_published(spark, f"{root}/log", rows.schema)

    def doubled(df):
        return df.withColumn("twice", F.col("logId") * 2)

    def lagged(df):
        from pyspark.sql import Window
        return df.withColumn("before", F.lag("twice").over(Window.partitionBy("address").orderBy("logId")))
    s = state.RatedStream(spark, rate=[doubled, lagged], is_quote=F.lit(False), is_usd_quote=F.lit(False), quote_key="address",
                          target=f"{root}/out", root=root, expiry=100, output=lambda df: df.select("date", "logId", "before"))
    for k in range(2):
        s.process(published.where((F.col("logId") / 20).cast("int") == k), k)
    assert {r["logId"]: r["before"] for r in spark.read.parquet(f"{root}/out").collect()} == {i: None if i < 2 else 2 * i - 4 for i in range(40)}
    assert scratch() == before and not spark.sparkContext._jsc.getPersistentRDDs()


def test_shuffle_files_go_with_their_query(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with sinks.shuffles_freed(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before
