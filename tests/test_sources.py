"""Typed event views (S26), SQL path scan (S17), look-back epochs."""

from pyspark.sql import functions as F

from tidepool.sources import events as src
from tidepool.sources import schemas as S
from tidepool.sources import sinks

BIG = "1461446703485210103287273052203988822378723970341"


def test_typed_event_views_decode_every_kept_event(spark):
    rows = [
        ("Pool", "Initialize", f'{{"sqrtPriceX96":"{BIG}","tick":-887271}}'),
        ("Pool", "Mint", f'{{"sender":"s","owner":"o","tickLower":-10,"tickUpper":10,"amount":"{BIG}","amount0":"1","amount1":"2"}}'),
        ("Pool", "Burn", '{"owner":"o","tickLower":-10,"tickUpper":10,"amount":"5","amount0":"1","amount1":"2"}'),
        ("Pool", "Flash", '{"sender":"s","recipient":"r","amount0":"1","amount1":"2","paid0":"3","paid1":"4"}'),
        ("Pool", "Swap", f'{{"amount0":"-1","amount1":"2","liquidity":"3","recipient":"r","sender":"s","sqrtPriceX96":"{BIG}","tick":7}}'),
        ("Factory", "PoolCreated", '{"token0":"a","token1":"b","fee":3000,"tickSpacing":60,"pool":"p"}'),
        ("NonfungiblePositionManager", "IncreaseLiquidity", '{"tokenId":"9","liquidity":"8","amount0":"7","amount1":"6"}'),
        ("NonfungiblePositionManager", "DecreaseLiquidity", '{"tokenId":"9","liquidity":"8","amount0":"7","amount1":"6"}'),
        ("NonfungiblePositionManager", "Collect", '{"tokenId":"9","recipient":"r","amount0":"7","amount1":"6"}'),
        ("NonfungiblePositionManager", "Transfer", '{"from":"f","to":"t","tokenId":"9"}'),
    ]
    df = spark.createDataFrame([(c, e, a, 1) for c, e, a in rows], "contract string, event string, args string, epoch int")
    views = src.typed_events(df)
    assert set(views) == set(S.EVENT_ARGS)
    for key, v in views.items():
        got = v.collect()
        assert len(got) == 1 and "args" not in v.columns
        assert set(S.EVENT_ARGS[key].fieldNames()) <= set(v.columns)
    assert views[("Pool", "Initialize")].first()["sqrtPriceX96"] == BIG     # lossless
    assert views[("Pool", "Mint")].first()["tickLower"] == -10
    assert views[("Factory", "PoolCreated")].first()["fee"] == 3000
    typed = src.typed_structs(df)
    assert typed._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    for r in typed.collect():  # one struct a row, that of its event
        assert [f"{c}_{e}" for c, e in S.EVENT_ARGS if r[f"{c}_{e}"] is not None] == [f"{r['contract']}_{r['event']}"]
        if r["event"] == "Initialize":
            assert r["Pool_Initialize"].asDict() == {"sqrtPriceX96": BIG, "tick": -887271}


def test_sql_path_scan_and_lookback(spark):
    path = sinks.scratch_path(spark, "t-sqlscan")
    spark.range(0, 250).select(F.col("id").alias("blockNumber"),
                               (F.col("id") / 100).cast("int").alias("epoch")).write.parquet(path)
    assert src.sql_path_scan(spark, path, "epoch = 1").count() == 100
    tagged = src.lookback_epochs(src.sql_path_scan(spark, path), epoch_length=100, block_expiry=10)
    per = {r["ratingEpoch"]: r["n"] for r in tagged.groupBy("ratingEpoch").agg(F.count("*").alias("n")).collect()}
    assert per == {0: 100, 1: 110, 2: 60}
