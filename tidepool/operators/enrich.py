"""Per-swap enrichment: identity, price, volume, tick liquidity, rate prep.

P11-P15, J2-J3. Only ``swap_price`` / ``swap_volume`` touch exact literals
(Arrow UDFs); everything else is built-in column arithmetic.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidepool.functions import exact as X
from tidepool.functions.columns import per_side
from tidepool.session import ETH_ADDRESS

TWO_POW_96 = 2 ** 96
MAX_INDEX = 99999  # five digits per index inside logId


def log_id_expr(block: Column, tx_index: Column, log_index: Column) -> Column:
    """``blockNumber + 0.<txIndex:5><logIndex:5>`` as decimal(38,18).

    An index above 99,999 would collide with its neighbour, so it fails loud.
    """
    frac = F.concat(F.lit("0."), F.lpad(tx_index.cast("string"), 5, "0"),
                    F.lpad(log_index.cast("string"), 5, "0")).cast("decimal(25,10)")
    value = (block.cast("decimal(20,0)") + frac).cast("decimal(38,18)")
    return (F.when((tx_index > MAX_INDEX) | (log_index > MAX_INDEX),
                   F.raise_error(F.lit("transaction or log index above 99999 in logId")).cast("decimal(38,18)"))
             .otherwise(value))


def with_log_id(df: DataFrame) -> DataFrame:
    return df.withColumn("logId", log_id_expr(F.col("blockNumber"), F.col("transactionIndex"),
                                              F.col("logIndex")))


def join_swaps(swaps: DataFrame, transactions: DataFrame, pools: DataFrame) -> DataFrame:
    """J2 + J3: swaps left-joined to their transaction and their pool.

    The transaction join is a sort-merge on (blockNumber, transactionHash);
    the pool side is broadcast by AQE when its measured size allows it.
    """
    return (swaps.join(transactions, ["blockNumber", "transactionHash"], "left")
                 .join(pools, ["address"], "left"))


@arrow_udf(StructType([StructField("price1", StringType()), StructField("price0", StringType()), StructField("root", DoubleType())]))
def _prices(root: pa.Array, decimals: pa.Array) -> pa.Array:
    one, roots = (1, 1), [X.parse(r) for r in root.to_pylist()]
    price1 = [X.scale(X.mul(r, r), d, 192) for r, d in zip(roots, decimals.to_pylist(), strict=True)]
    return pa.StructArray.from_arrays([
        pa.array(map(X.fmt, price1), pa.string()), pa.array([X.fmt(X.div(one, p)) for p in price1], pa.string()),
        pa.array([X.to_float(X.div(r, (TWO_POW_96, 1))) for r in roots], pa.float64())], names=["price1", "price0", "root"])


def swap_price(df: DataFrame, sqrt_col: str = "sqrtPriceX96") -> DataFrame:
    """price1 = sqrtP^2 * 10^(dec0-dec1) / 2^192, price0 = 1 / price1,
    resolvedSqrtPrice = sqrtP / 2^96 as a double. One Arrow pass."""
    found = _prices(F.col(sqrt_col), (F.col("token1.decimals") - F.col("token0.decimals")).cast("long"))
    return (df.withColumn("__p", found)
              .withColumns({"price1": F.col("__p.price1"), "price0": F.col("__p.price0"), "resolvedSqrtPrice": F.col("__p.root")}).drop("__p"))


#: A pool's fee is in millionths.
FEE_DECIMALS = 6
PARTS = ("amount", "fee", "netAmount", "volume")
VOLUME_FIELDS = [f"{part}{t}" for part in PARTS for t in "01"]


def _side_parts(amount: str | None, fee) -> tuple:
    """fee, net amount and volume of one side's amount literal."""
    value = X.parse(amount)
    taken = X.mul(value, fee) if value is not None and fee is not None and value[0] > 0 else (0, 1)
    net = X.sub(value, taken)
    return X.fmt(taken) if taken[0] else "0", X.fmt(net), X.fmt(None if net is None else (abs(net[0]), net[1]))


@arrow_udf(StructType([StructField(f, StringType()) for f in VOLUME_FIELDS[2:]]))
def _wide_volume(amount0: pa.Array, amount1: pa.Array, fee: pa.Array) -> pa.Array:
    """The parts of amounts too wide for the decimal lane (null elsewhere)."""
    out = []
    if amount0.null_count + amount1.null_count < 2 * len(fee):
        rates = [X.parse(f"{f}e{FEE_DECIMALS}") if f is not None else None for f in fee.to_pylist()]
        sides = [[_side_parts(a, r) if a is not None else (None,) * 3 for a, r in zip(x.to_pylist(), rates, strict=True)] for x in (amount0, amount1)]
        out = [pa.array([row[k] for row in side], pa.string()) for k in range(3) for side in sides]
    return pa.StructArray.from_arrays(out or [pa.nulls(len(fee), pa.string())] * 6, names=VOLUME_FIELDS[2:])


def swap_volume(df: DataFrame) -> DataFrame:
    """P14 (fused, P16's single-pass form): scaled amounts; the pool fee
    applies to the incoming (positive) side only (B13); net amount; absolute
    volume. Amounts of up to 28 digits are whole-number arithmetic on built-in
    decimals; one Arrow pass takes the others of both sides."""
    kept = [c for c in df.columns if c not in VOLUME_FIELDS]
    rate = F.col("fee").cast("long")
    fits_rate = rate.between(0, 10 ** 9 - 1)
    zero, unit = F.lit(0).cast("decimal(38,0)"), F.lit(10 ** FEE_DECIMALS).cast("decimal(7,0)")
    whole, taken, net, literal, lane = {}, {}, {}, {}, {}
    for t in "01":
        raw, decimals = F.col(f"amount{t}").cast("string"), F.col(f"token{t}.decimals").cast("long")
        literal[t] = F.nullif(F.concat_ws("e", raw, decimals.cast("string")), F.lit(""))
        whole[t] = F.when((F.translate(raw, "0123456789-", "") == "") & (F.length(raw) <= 28) & decimals.isNotNull() & fits_rate, raw.try_cast("decimal(28,0)"))
        w, fee, rest, form = F.col(f"__whole{t}"), F.col(f"__taken{t}"), F.col(f"__net{t}"), lambda v, d=decimals: X.decimal_literal(v, d + FEE_DECIMALS)
        taken[t] = F.when(w > 0, w * rate.cast("decimal(9,0)")).otherwise(zero)
        net[t] = (w * unit - fee).cast("decimal(38,0)")
        lane[t] = {"in": w.isNotNull(), "fee": F.when(fee == 0, "0").otherwise(form(fee)), "netAmount": form(rest), "volume": form(F.abs(rest))}
    # columns of their own, so that a row's casts and products are made once
    for name, made in (("__whole", whole), ("__taken", taken), ("__net", net)):
        df = df.withColumns({f"{name}{t}": made[t] for t in "01"})
    df = df.withColumn("__wide", _wide_volume(*[F.when(~lane[t]["in"], literal[t]) for t in "01"], rate))
    # an amount that is null altogether takes no fee
    parts = {f"{part}{t}": F.when(lane[t]["in"], lane[t][part]).when(literal[t].isNotNull(), F.col(f"__wide.{part}{t}")).otherwise(F.lit("0") if part == "fee" else F.lit(None))
             for part in PARTS[1:] for t in "01"}
    made = {f"amount{t}": F.coalesce(literal[t], F.lit("")) for t in "01"} | parts
    return df.select(*kept, *[made[f].alias(f) for f in VOLUME_FIELDS])


TICK_BASE = 1.0001  # fixed value: price step of one tick


def amounts_between(liquidity: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """Token amounts that a liquidity holds between two square root prices:
    L (1/low - 1/high) of token 0 and L (high - low) of token 1."""
    span = liquidity * (high - low)
    return liquidity * (high - low) / (low * high), span


def tick_liquidity(df: DataFrame) -> DataFrame:
    """What is left of both tokens in the current tick (token 0 above the
    price, token 1 below it) and what the whole tick holds, in whole tokens,
    double precision."""
    floor_tick = F.floor(F.col("tick") / F.col("tickSpacing")) * F.col("tickSpacing")
    ends = [F.pow(F.lit(TICK_BASE), t / 2) for t in (floor_tick, floor_tick + F.col("tickSpacing"))]
    now, held = F.col("resolvedSqrtPrice"), F.col("liquidity").cast("double")
    above, below = amounts_between(held, now, ends[1])[0], amounts_between(held, ends[0], now)[1]
    whole = amounts_between(held, *ends)
    unit = [F.pow(F.lit(10), F.col(f"token{t}.decimals").cast("double")) for t in (0, 1)]
    return df.withColumns({"tickAmount0": above / unit[0], "tickAmount1": below / unit[1],
                           "tickDepth0": whole[0] / unit[0], "tickDepth1": whole[1] / unit[1]})


def exchange_rate_prep(df: DataFrame, base_token: str = ETH_ADDRESS) -> DataFrame:
    """Whether a pool holds the base token (null if that is unknown), on
    which side (null elsewhere), and the token paired with it. In other pools
    each side's paired token is its own."""
    is_base = [F.col(f"token{t}.address") == F.lit(base_token) for t in (0, 1)]
    holds = is_base[0] | is_base[1]
    paired = F.when(is_base[1], F.col("token0")).when(is_base[0], F.col("token1"))
    return df.withColumns({"isBasePool": holds, "is1": F.when(holds, is_base[1]), "pairedToken": paired,
                           **per_side(pairedToken=lambda s: F.when(holds, paired).otherwise(s("token")))})
