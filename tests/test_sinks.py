"""Sinks: upsert replay, partition overwrite, catalog partitions, JSON, pool records."""

import datetime as dt

from pyspark.sql import functions as F

from tidepool.operators import checks
from tidepool.sources import events as src
from tidepool.sources import schemas as S
from tidepool.sources import sinks


def test_upsert_replay_is_idempotent(spark):
    path = sinks.scratch_path(spark, "t-upsert")
    base = spark.createDataFrame([("d1", 1, 1.0), ("d1", 2, 2.0), ("d2", 3, 3.0)], "date string, logId long, v double")
    batch = spark.createDataFrame([("d1", 2, 20.0), ("d3", 4, 4.0), ("d3", 4, 5.0)], "date string, logId long, v double")
    sinks.upsert(base, path, batch_id=0)
    sinks.upsert(batch, path, batch_id=1, newest="v")
    first = sorted(map(tuple, spark.read.parquet(path).select("date", "logId", "v").collect()))
    sinks.upsert(batch, path, batch_id=1, newest="v")     # replay
    again = sorted(map(tuple, spark.read.parquet(path).select("date", "logId", "v").collect()))
    assert first == again == [("d1", 1, 1.0), ("d1", 2, 20.0), ("d2", 3, 3.0), ("d3", 4, 5.0)]


def test_overwrite_keeps_other_partitions(spark):
    path = sinks.scratch_path(spark, "t-over")
    sinks.overwrite_partitions(spark.createDataFrame([("a", 1), ("b", 2)], "date string, v int"), path)
    sinks.overwrite_partitions(spark.createDataFrame([("b", 3)], "date string, v int"), path)
    got = sorted(map(tuple, spark.read.parquet(path).select("date", "v").collect()))
    assert got == [("a", 1), ("b", 3)]


def test_partition_update_new_and_old_table(spark):
    """Golden of the partition test: new table -> today..today+3; a table
    with a partition two days ago -> that day..today+3."""
    import uuid
    db = f"tp_t_{uuid.uuid4().hex[:8]}"
    today = dt.date(2024, 3, 10)
    sinks.create_database(spark, db)
    for name in ("new_t", "old_t"):
        sinks.create_external_table(spark, f"{db}.{name}", sinks.scratch_path(spark, name),
                                    ddl="c INT, date STRING", partitioned_by="date")
    spark.sql(f"ALTER TABLE {db}.old_t ADD PARTITION (date='{today - dt.timedelta(days=2)}')")
    for name, start in (("new_t", today), ("old_t", today - dt.timedelta(days=2))):
        sinks.update_partitions(spark, f"{db}.{name}", today=today.isoformat())
        got = [r["value"] for r in sinks.partitions(spark, f"{db}.{name}").orderBy("value").collect()]
        want = [(start + dt.timedelta(days=i)).isoformat() for i in range((today - start).days + 4)]
        assert got == want


def test_lossless_json_round_trip(spark):
    text = ('{"amount0":"94027150752759122855288085421985","amount1":"-94027150752759122855288085421986",'
            '"liquidity":"133781798900345601581411106757","recipient":"0x0000000000007F150Bd6f54c40A34d7C3d5e9f56",'
            '"sender":"0x0000000000007F150Bd6f54c40A34d7C3d5e9f56",'
            '"sqrtPriceX96":"1461446703485210103287273052203988822378723970341","tick":887271}')
    df = spark.createDataFrame([(text,)], "value string")
    out = checks.json_round_trip(df, "value", S.swap_args_schema()).first()
    assert out["reencoded"] == text and out["same"] == "true"


def test_pool_start_records_with_and_without_history(spark):
    batch = spark.createDataFrame(
        [('{"pool": "0x1d42064Fc4Beb5F8aAF85F4617AE8b3b5B8Bd801"}', 12369739, "PoolCreated", 412),
         ('{"pool": "0x6c6Bc977E13Df9b0de53b251522280BB72383700"}', 12369760, "PoolCreated", 412)],
        "args string, blockNumber long, event string, epoch int")
    missing = src.filtered_dataset(spark, "/nonexistent/tidepool/path", epoch=412,
                                   schema=batch.schema)
    assert missing.count() == 0
    no_hist = src.pool_start_records(missing, batch).collect()
    assert [(r["address"], r["startBlock"], r["name"]) for r in no_hist] == [
        ("0x1d42064Fc4Beb5F8aAF85F4617AE8b3b5B8Bd801", 12369739, "Pool"),
        ("0x6c6Bc977E13Df9b0de53b251522280BB72383700", 12369760, "Pool")]
    path = sinks.scratch_path(spark, "t-factory")
    sinks.write_partitioned(batch.withColumn("epoch", F.lit(411)), path, "epoch")
    hist = src.filtered_dataset(spark, path, epoch=412, schema=batch.schema)
    assert src.pool_start_records(hist, batch).count() == 4


def test_range_join_and_reconcile(spark):
    pts = spark.createDataFrame([(i,) for i in range(0, 50)], "b long")
    rng = spark.createDataFrame([("x", 0, 9), ("y", 10, 31), ("z", 32, 49)], "d string, lo long, hi long")
    got = {r["d"]: r["n"] for r in checks.range_join(pts, rng, "b", "lo", "hi", 8)
           .groupBy("d").agg(F.count("*").alias("n")).collect()}
    assert got == {"x": 10, "y": 22, "z": 18}
    a = spark.createDataFrame([(1, "p"), (1, "q"), (2, "r")], "period int, v string")
    b = spark.createDataFrame([(1, "p"), (1, "q"), (2, "s")], "period int, v string")
    rep = {r["period"]: r["identical"] for r in checks.reconcile(a, b, "period").collect()}
    assert rep == {1: "true", 2: "false"}


def test_ordered_publish_is_a_global_sort_and_decodes_back(spark):
    import glob

    import pyarrow.parquet as pq
    path = sinks.scratch_path(spark, "t-publish")
    df = spark.range(0, 500).select(F.col("id").alias("logId"), (F.col("id") % 7).cast("string").alias("address"),
                                    (F.col("id") * 3).cast("string").alias("amount"))
    sinks.ordered_publish(df.repartition(5), path, partitions=4)
    ranges = []
    for f in sorted(glob.glob(f"{path.replace('file:', '')}/*.parquet")):
        order = pq.read_table(f).column("order").to_pylist()
        if order:
            assert order == sorted(order)
            ranges.append((order[0], order[-1]))
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    back = sinks.read_published(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_upsert_loses_no_row_or_column(spark):
    import pytest
    from tidepool.sources import sinks
    path = sinks.scratch_path(spark, "t-upsert-wide")
    first = spark.createDataFrame([("2024-01-01", 1, "a", "x"), ("2024-01-01", 2, "b", "y")], "date string, logId long, v string, extra string")
    sinks.upsert(first, path)
    sinks.upsert(spark.createDataFrame([("2024-01-01", 2, "c")] * 2, "date string, logId long, v string"), path)
    got = {r["logId"]: (r["v"], r["extra"]) for r in spark.read.parquet(path).collect()}
    assert got == {1: ("a", "x"), 2: ("c", None)}
    two = spark.createDataFrame([("2024-01-01", 3, "d"), ("2024-01-01", 3, "e")], "date string, logId long, v string")
    with pytest.raises(ValueError):
        sinks.upsert(two, path)


def test_publish_in_order_deals_every_range_to_as_many_files(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").alias("logId"), F.lit("A").alias("address"), (F.col("id") * 2).alias("v"))
    path = str(tmp_path / "log")
    assert sinks.publish_in_order(df, path, batches=3, files=8) == 8
    rows = spark.read.parquet(path).select("order", F.input_file_name().alias("f"))
    ranges = [(r["lo"], r["hi"]) for r in rows.groupBy("f").agg(F.min("order").alias("lo"), F.max("order").alias("hi")).collect()]
    assert len(ranges) == 24 and rows.count() == 3000
    assert sorted(lo // 1000 for lo, _ in ranges) == sorted(hi // 1000 for _, hi in ranges) == [0] * 8 + [1] * 8 + [2] * 8
    few = str(tmp_path / "few")
    n = sinks.publish_in_order(df.limit(6), few, batches=3, files=8)
    assert n in (1, 2) and spark.read.parquet(few).select(F.input_file_name()).distinct().count() == 3 * n
