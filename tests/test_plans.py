"""Plan shape of the heavy queries: what must hold at scale."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF001


def _plan(spark, name):
    df = E.queries()[name](spark, SF001)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["pool_day_stats", "asof_quote_global", "previous_delta", "rated_swaps_job",
                                  "in_out_check", "top_recipients", "tolerance_diff"])
def test_no_cross_or_nested_loop_join(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name,max_shuffles", [("previous_delta", 2), ("asof_quote_global", 2),
                                               ("base_amounts", 4)])
def test_rated_chain_reads_input_once(spark, name, max_shuffles):
    plan = _plan(spark, name)
    assert len(re.findall(r"Scan parquet", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= max_shuffles
    assert "SinglePartition" not in plan


def test_top_k_is_take_ordered(spark):
    df = E.queries()["top_recipients"](spark, SF001)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_roll_up_has_no_single_partition_stage(spark):
    plan = _plan(spark, "pool_day_stats")
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan


def test_volume_and_resolve_read_an_amount_once(spark):
    from pyspark.sql import functions as F

    from tidepool.functions import exact as X
    from tidepool.operators import enrich
    wide = "1" + "0" * 30
    token = "struct('C' AS symbol, cast(2 AS decimal(38,0)) AS decimals)"
    df = spark.createDataFrame([("200", "-3", 3000), (wide, "7.5", 500), ("1", "2", None)], "amount0 string, amount1 string, fee long")
    df = df.withColumns({"token0": F.expr(token), "token1": F.expr(token)})
    out = enrich.swap_volume(df).select(*[X.resolve(c).alias(c) for c in enrich.VOLUME_FIELDS[2:]])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as decimal(28,0)") == 2 and plan.count("regexp_replace(fee0") <= 2
    assert [tuple(r) for r in out.collect()] == [
        (0.006, 0.0, 1.994, -0.03, 1.994, 0.03), (5e24, 3.75e-05, 9.995e27, 0.0749625, 9.995e27, 0.0749625), (0.0, 0.0, 0.01, 0.02, 0.01, 0.02)]
