"""Declared schemas: raw events, blocks, tokens, typed event args, outputs.

Everything is explicit; no schema is inferred from a first row. Contract, event
and field names and their types are fixed values: the data has them.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DecimalType,
                               DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

LOG_ID = DecimalType(38, 18)

RAW_EVENTS = StructType([
    StructField("address", StringType()),
    StructField("blockNumber", LongType()),
    StructField("transactionHash", BinaryType()),
    StructField("event", StringType()),
    StructField("logIndex", LongType()),
    StructField("transactionIndex", LongType()),
    StructField("blockHash", BinaryType()),
    StructField("args", StringType()),
    StructField("contract", StringType()),
    StructField("epoch", IntegerType()),
])

TRANSACTION = StructType([
    StructField("hash", BinaryType()),
    StructField("gas", LongType()),
    StructField("gasPrice", StringType()),
    StructField("to", StringType()),
])

# baseFeePerGas is absent before the London upgrade: declared nullable here,
# so one read covers both epochs (no per-epoch schema reconciliation).
BLOCKS = StructType([
    StructField("number", LongType()),
    StructField("timestamp", LongType()),
    StructField("baseFeePerGas", StringType()),
    StructField("transactions", ArrayType(TRANSACTION)),
    StructField("date", StringType()),
    StructField("epoch", IntegerType()),
])

TOKEN = StructType([
    StructField("symbol", StringType()),
    StructField("decimals", DecimalType(38, 0)),
    StructField("address", StringType()),
])

QUOTE = StructType([
    StructField("poolAddress", StringType()),
    StructField("price", StringType()),
    StructField("is1", BooleanType()),
    StructField("logId", LOG_ID),
])

# Event args, one schema per kept event. Integers above 64 bits stay strings
# so nothing is lost; ``decimal_type`` switches that (as the reference's
# swap schema builder does).


def _args(fields, decimal_type="string"):
    kinds = {"big": decimal_type, "str": "string", "long": "long"}
    return StructType([StructField(n, _spark_type(kinds[k])) for n, k in fields])


def _spark_type(name):
    if name.startswith("decimal"):
        p, sc = name[name.index("(") + 1:-1].split(",")
        return DecimalType(int(p), int(sc))
    return {"string": StringType(), "long": LongType(), "double": DoubleType()}[name]


def swap_args_schema(decimal_type: str = "string") -> StructType:
    return _args([("amount0", "big"), ("amount1", "big"), ("liquidity", "big"),
                  ("recipient", "str"), ("sender", "str"), ("sqrtPriceX96", "big"),
                  ("tick", "long")], decimal_type)


EVENT_ARGS = {
    ("Factory", "PoolCreated"): _args([("token0", "str"), ("token1", "str"), ("fee", "long"),
                                       ("tickSpacing", "long"), ("pool", "str")]),
    ("NonfungiblePositionManager", "IncreaseLiquidity"): _args(
        [("tokenId", "big"), ("liquidity", "big"), ("amount0", "big"), ("amount1", "big")]),
    ("NonfungiblePositionManager", "DecreaseLiquidity"): _args(
        [("tokenId", "big"), ("liquidity", "big"), ("amount0", "big"), ("amount1", "big")]),
    ("NonfungiblePositionManager", "Collect"): _args(
        [("tokenId", "big"), ("recipient", "str"), ("amount0", "big"), ("amount1", "big")]),
    ("NonfungiblePositionManager", "Transfer"): _args(
        [("from", "str"), ("to", "str"), ("tokenId", "big")]),
    ("Pool", "Initialize"): _args([("sqrtPriceX96", "big"), ("tick", "long")]),
    ("Pool", "Swap"): swap_args_schema(),
    ("Pool", "Mint"): _args([("sender", "str"), ("owner", "str"), ("tickLower", "long"),
                             ("tickUpper", "long"), ("amount", "big"), ("amount0", "big"),
                             ("amount1", "big")]),
    ("Pool", "Burn"): _args([("owner", "str"), ("tickLower", "long"), ("tickUpper", "long"),
                             ("amount", "big"), ("amount0", "big"), ("amount1", "big")]),
    ("Pool", "Flash"): _args([("sender", "str"), ("recipient", "str"), ("amount0", "big"),
                              ("amount1", "big"), ("paid0", "big"), ("paid1", "big")]),
}

# day_swaps table: 64 data columns + date (DDL in sinks.DAY_SWAPS_DDL)
SERIES_PRICE = "array<struct<logId:decimal(38,18),time:timestamp,price:double,priceDeltaPct:double,netAmount:double,volume:double>>"
SERIES_COST = ("array<struct<logId:decimal(38,18),time:timestamp,volumeUsd:double,gas:bigint,"
               "gasXTipUsd:double,gasXBaseFeeUsd:double,LPFeeUsd:double,tipGwei:double,"
               "baseFeeGwei:double,totalFeePct:double>>")
