"""Swap-like views over the driver's tables.

The driver tables hold no swaps, so each operator runs on a view with the
same semantics (``event_id`` is the unique order key):

``swap_log`` (events): one swap per event. Pool = ``'A' || user_id % 12``;
pools 0, 4, 8 pair the base token ETH with T1..T3 (quote pools), pools 1,
5, 9 are ETH/T0 where T0 is the US-dollar token, the rest pair two other
tokens. price1 = ``value`` as an exact 2-decimal literal, amounts from the
value in cents, gas from ``props.k``. Every view reads whole tables; the
work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import exact as X

# Fixed values of the views (not of the reference).
BASE_TOKEN = "ETH"
USD_TOKEN = "T0"
N_POOLS = 12
POOL_FEES = (500, 3000, 10000)          # by pool % 3
TICK_SPACINGS = (10, 60, 200)


def epoch_seconds(c: Column) -> Column:
    """Seconds since the epoch of a (zone-less) timestamp, read as UTC."""
    return F.unix_seconds(c.cast("timestamp"))


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A driver table; ``spread`` before Arrow-UDF-heavy work (see ``layout.spread``)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if spread:
        from tidepool.operators.layout import spread as _spread
        df = _spread(df)
    return df


def _token(symbol: Column, decimals: int = 2) -> Column:
    return F.struct(symbol.alias("symbol"), F.lit(decimals).cast("decimal(38,0)").alias("decimals"),
                    symbol.alias("address"))


def _pick(idx: Column, values) -> Column:
    out = F.lit(values[-1])
    for i in range(len(values) - 2, -1, -1):
        out = F.when(idx == i, F.lit(values[i])).otherwise(out)
    return out


def swap_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw swap rows: identity, pool, tokens, price, amounts, tick, gas."""
    ev = table(spark, sf_dir, "events", spread=True)
    p = F.col("user_id") % N_POOLS
    kind = p % 4
    paired = F.concat(F.lit("T"), (F.lit(1) + (p / 4).cast("int")).cast("string"))
    is1_q = p == 4
    t0 = (F.when(kind == 0, F.when(is1_q, paired).otherwise(F.lit(BASE_TOKEN)))
           .when(kind == 1, F.lit(BASE_TOKEN))
           .otherwise(F.concat(F.lit("T"), (p % 5).cast("string"))))
    t1 = (F.when(kind == 0, F.when(is1_q, F.lit(BASE_TOKEN)).otherwise(paired))
           .when(kind == 1, F.lit(USD_TOKEN))
           .otherwise(F.concat(F.lit("T"), ((p + 2) % 5).cast("string"))))
    k = F.from_json(F.col("props"), "k long")["k"]
    cents = F.round(F.col("value") * 100).cast("long")
    side = F.when(k % 2 == 0, F.lit(1)).otherwise(F.lit(-1))
    mult = F.col("user_id") % 3 + 1
    return ev.select(
        F.col("event_id"),
        F.col("event_id").alias("logId"),
        F.col("event_id").alias("blockNumber"),
        F.concat(F.lit("A"), p.cast("string")).alias("address"),
        epoch_seconds(F.col("ts")).alias("timestamp"),
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("date"),
        _token(t0).alias("token0"), _token(t1).alias("token1"),
        _pick(p % 3, POOL_FEES).cast("long").alias("fee"),
        _pick(p % 3, TICK_SPACINGS).cast("long").alias("tickSpacing"),
        (k - 50).alias("tick"),
        cents.cast("string").alias("liquidity"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("price1"),
        (cents * side).cast("string").alias("amount0"),
        (-cents * side * mult).cast("string").alias("amount1"),
        (F.lit(1.0) + (k % 7) / 1000.0).alias("resolvedSqrtPrice"),
        (k + 21).alias("gas"),
        F.concat((F.col("user_id") + 1).cast("string"), F.lit("e3")).alias("gasPrice"),
        F.when(F.col("event_id") % 10 != 0, F.lit("5e3")).alias("baseFeePerGas"),
        F.col("event_type"),
    )


def with_price0(df: DataFrame) -> DataFrame:
    return df.withColumn("price0", X.div_(X.lit(1), F.col("price1")))


def with_gas_amounts(df: DataFrame) -> DataFrame:
    """S6's exact gas columns on the view (prices in thousandths)."""
    from tidepool.sources import events
    return events.with_gas_amounts(df, 3)


def blocks(spark: SparkSession, sf_dir: str, london_block: int = 5000) -> DataFrame:
    """Orders as blocks with a nested array of their lines as transactions.

    ``baseFeePerGas`` exists only from ``london_block`` on; the two shapes are
    unioned by name (U1), as blocks before and after the upgrade differ.
    """
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    tx = F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("hash"),
        F.col("l_quantity").cast("long").alias("gas"),
        F.round(F.col("l_extendedprice") * 100).cast("long").cast("string").alias("gasPrice"),
        F.col("l_suppkey").cast("string").alias("to"))
    lines = li.groupBy("l_orderkey").agg(F.collect_list(tx).alias("transactions"))
    raw = orders.select(F.col("o_orderkey").alias("number"),
                        epoch_seconds(F.col("o_orderdate")).alias("timestamp"),
                        F.round(F.col("o_totalprice")).cast("long").cast("string").alias("baseFeePerGas"),
                        (F.col("o_orderkey") / 1000).cast("long").cast("int").alias("epoch"))
    from tidepool.sources.events import union_epochs
    old = raw.where(F.col("number") < london_block).drop("baseFeePerGas")
    new = raw.where(F.col("number") >= london_block)
    b = union_epochs([old, new])
    return b.join(lines, b["number"] == lines["l_orderkey"], "left").drop("l_orderkey")


def rated_view(spark: SparkSession, sf_dir: str, *, chunk_width: float = 1000,
               delta_expiry: float = 20, base_expiry: float = 100,
               usd_expiry: float = 10) -> DataFrame:
    """The rated-swap chain of the reference on ``swap_log``: price, volume,
    tick liquidity, rate prep, gas amounts, previous-swap delta, base quotes
    per paired token, USD quote, base amounts, fees, USD amounts, day tags."""
    from tidepool.operators import daily, enrich, rate
    from tidepool.sources.events import pool_name
    s = swap_log(spark, sf_dir)
    s = with_price0(s)
    s = enrich.swap_volume(s)
    s = enrich.tick_liquidity(s)
    s = enrich.exchange_rate_prep(s, base_token=BASE_TOKEN)
    s = s.withColumn("pool", pool_name(F.col("token0.symbol"), F.col("token1.symbol"), F.col("fee")))
    s = with_gas_amounts(s)
    s = rate.swap_delta(s, expiry=delta_expiry, chunk_width=chunk_width)
    s = rate.base_exchange_rate(s, base_token=BASE_TOKEN, expiry=base_expiry, chunk_width=chunk_width)
    s = rate.usd_exchange_rate(s, usd_token=USD_TOKEN, expiry=usd_expiry, chunk_width=chunk_width)
    s = rate.base_amounts(s, base_token=BASE_TOKEN)
    s = rate.total_fees(s)
    s = rate.usd_amounts(s, usd_token=USD_TOKEN)
    return daily.day_tags(s)
