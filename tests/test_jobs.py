"""The two published jobs on reference-shaped tables, with their sinks."""

from pyspark.sql import functions as F

from tests.conftest import SF001, SF01
from tidepool.plans import catalog, jobs
from tidepool.plans import views as V
from tidepool.sources import sinks


def test_epoch_run_equals_all_epochs_for_that_epoch(spark):
    events, blocks, tokens = catalog.reference_tables(spark, SF01)
    kw = dict(block_expiry=catalog.JOB_EXPIRY, epoch_length=catalog.JOB_EPOCH_LENGTH,
              base_token=V.BASE_TOKEN, usd_token=V.USD_TOKEN, chunk_width=1000)
    one = jobs.rated_swaps(events, blocks, tokens, epoch=3, **kw)
    every = jobs.rated_swaps(events, blocks, tokens, epoch=None, **kw).where(F.col("epoch") == 3)
    cols = ["logId", "price1", "volume0", "priceDelta0", "tickDelta", "base0", "base1", "usdBase", "totalFees"]
    a, b = one.select(*cols), every.select(*cols)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # every swap found its transaction and its pool
    assert one.where(F.col("gas").isNull() | F.col("pool").isNull()).count() == 0


def test_day_job_writes_day_partitions(spark):
    events, blocks, tokens = catalog.reference_tables(spark, SF001)
    rated = jobs.rated_swaps(events, blocks, tokens, block_expiry=100, epoch_length=1000,
                             base_token=V.BASE_TOKEN, usd_token=V.USD_TOKEN, chunk_width=1000)
    rpath, dpath = sinks.scratch_path(spark, "t-rated"), sinks.scratch_path(spark, "t-days")
    jobs.write_rated_swaps(rated, rpath, batch_id=0)
    stored = spark.read.parquet(rpath)
    assert stored.count() == rated.count()
    days = jobs.day_swaps(stored.withColumn("date", F.col("date").cast("string")))
    jobs.write_day_swaps(days, dpath)
    back = spark.read.parquet(dpath)
    assert back.agg(F.sum("swapCount")).first()[0] == stored.count()
    assert back.select("date").distinct().count() == stored.select("date").distinct().count()
