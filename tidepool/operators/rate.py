"""Exchange rates and converted amounts: W1-W3, J4-J6, P17-P21.

The quote look-ups are the chunked as-of operator of ``asof``; amounts are
exact literals converted by one fused Arrow UDF per value (the CASE logic of
the conversion runs in the same Python pass as the arithmetic, so a CASE
does not evaluate four UDF branches for every row).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from tidepool.functions import exact as X
from tidepool.operators.asof import Lookup, look_up, quote_struct
from tidepool.session import BLOCK_EXPIRY, ETH_ADDRESS, USDC_ADDRESS

# window-partition span in blocks: the expiry for quote searches (only quote
# rows are copied), wider for the delta (every row of a chunk tail is copied)
DEFAULT_CHUNK = BLOCK_EXPIRY
DELTA_CHUNK = 4 * BLOCK_EXPIRY


# -- W3: previous swap of the same pool ----------------------------------------

DELTA_FIELDS = ["priceDelta0", "priceDelta1", "priceDeltaPct0", "priceDeltaPct1"]


@arrow_udf(StructType([StructField("priceDelta0", StringType()), StructField("priceDelta1", StringType()),
                       StructField("priceDeltaPct0", DoubleType()), StructField("priceDeltaPct1", DoubleType())]))
def _delta(p0: pa.Array, p1: pa.Array, l0: pa.Array, l1: pa.Array) -> pa.Array:
    deltas, percents = [], []
    for price, before in ((p0, l0), (p1, l1)):
        was = [X.parse(x) for x in X.rows_of(before)]
        moved = [X.sub(X.parse(x), y) for x, y in zip(X.rows_of(price), was, strict=True)]
        parts = [X.to_float(X.div(d, y)) for d, y in zip(moved, was, strict=True)]
        deltas.append(pa.array(map(X.fmt, moved), pa.string()))
        percents.append(pa.array([None if x is None else x * 100 for x in parts], pa.float64()))
    return pa.StructArray.from_arrays([*deltas, *percents], names=DELTA_FIELDS)


def delta_lookup(key: str = "address", order: str = "logId", expiry: float = BLOCK_EXPIRY) -> Lookup:
    """The previous swap of the pool; it counts only within the expiry."""
    value = F.struct(F.col(order).alias(order), F.col("price0").alias("price0"),
                     F.col("price1").alias("price1"), F.col("tick").alias("tick"))
    return Lookup(key, F.lit(True), value, "__prev", expiry=expiry)


def swap_delta(df: DataFrame, *, key: str = "address", order: str = "logId",
               expiry: float = BLOCK_EXPIRY, chunk_width: float = DELTA_CHUNK) -> DataFrame:
    """lastPrice0/1, priceDelta0/1, priceDeltaPct0/1 (percent of the previous
    price) and tickDelta; null on a pool's first row and when the previous
    swap is more than ``expiry`` older (the previous row is still the state)."""
    return _with_delta(look_up(df, [delta_lookup(key, order, expiry)], order=order, chunk_width=chunk_width))


def _with_delta(out: DataFrame) -> DataFrame:
    """The delta columns from ``__prev``, the previous row's struct."""
    live = F.col("__prev").isNotNull()
    p = F.col("__prev")
    out = out.withColumns({
        "lastPrice0": F.when(live, p["price0"]),
        "lastPrice1": F.when(live, p["price1"]),
        "tickDelta": F.when(live, F.col("tick") - p["tick"]),
    })
    d = _delta(F.col("price0"), F.col("price1"), F.col("lastPrice0"), F.col("lastPrice1"))
    out = out.withColumn("__d", d).withColumns({c: F.col(f"__d.{c}") for c in DELTA_FIELDS}).drop("__d")
    return out.drop("__prev")


# -- J4-J6: as-of quotes with expiry -------------------------------------------

def _is_quote(token: str) -> Column:
    return F.coalesce(F.col("isBasePool"), F.lit(False)) & \
        F.lit(token).isin(F.col("token0.address"), F.col("token1.address"))


def _quote_value() -> Column:
    return quote_struct(F.col("address"), F.col("price1"), F.col("is1"), F.col("logId"))


def base_lookups(base_token: str = ETH_ADDRESS, expiry: float = BLOCK_EXPIRY) -> list[Lookup]:
    """Base-pool quotes of the paired token of either side."""
    return [Lookup(f"pairedToken{t}.address", _is_quote(base_token), _quote_value(), f"base{t}", expiry=expiry, self_excluded=True)
            for t in ("0", "1")]


def usd_lookup(usd_token: str = USDC_ADDRESS, expiry: float = BLOCK_EXPIRY) -> Lookup:
    """Quotes of the base token in US dollars, for every row."""
    return Lookup(None, _is_quote(usd_token), _quote_value(), "usdBase", expiry=expiry, self_excluded=True)


def base_exchange_rate(df: DataFrame, *, base_token: str = ETH_ADDRESS,
                       expiry: float = BLOCK_EXPIRY, chunk_width: float = DEFAULT_CHUNK) -> DataFrame:
    """J4 then J5: latest earlier, non-expired base-pool quote of the paired
    token of side 0 (``base0``) and of side 1 (``base1``), keyed by the paired
    token's address. A quote row gets no quote of its own (B9)."""
    return look_up(df, base_lookups(base_token, expiry), order="logId", chunk_width=chunk_width)


def usd_exchange_rate(df: DataFrame, *, usd_token: str = USDC_ADDRESS,
                      expiry: float = BLOCK_EXPIRY, chunk_width: float = DEFAULT_CHUNK) -> DataFrame:
    """Latest earlier ETH/USD quote for every row (one global key, split
    into chunks: no single-task window)."""
    return look_up(df, [usd_lookup(usd_token, expiry)], order="logId", chunk_width=chunk_width)


def delta_and_quotes(df: DataFrame, *, base_token: str = ETH_ADDRESS, usd_token: str = USDC_ADDRESS,
                     expiry: float = BLOCK_EXPIRY, chunk_width: float = DEFAULT_CHUNK) -> DataFrame:
    """W3, J4, J5 and J6. Where rows are so dense that a chunk must be narrower
    than the expiry, what earlier chunks give is found for all four in one
    narrow scan; ``df`` should then be a table. Else each is one shuffle."""
    if chunk_width < expiry:
        lookups = [delta_lookup(expiry=expiry), *base_lookups(base_token, expiry), usd_lookup(usd_token, expiry)]
        return _with_delta(look_up(df, lookups, order="logId", chunk_width=chunk_width))
    # the delta copies every row of a chunk's tail, so its chunks are wider
    s = swap_delta(df, expiry=expiry, chunk_width=max(chunk_width, 4 * expiry))
    s = base_exchange_rate(s, base_token=base_token, expiry=expiry, chunk_width=chunk_width)
    return usd_exchange_rate(s, usd_token=usd_token, expiry=expiry, chunk_width=chunk_width)


def rolling_quotes(df: DataFrame, *, usd_token: str = USDC_ADDRESS,
                   base_candidate: Column | None = None,
                   chunk_width: float = DEFAULT_CHUNK) -> DataFrame:
    """W1 + W2 (deprecated in the reference): latest quote up to and including
    the current row, no expiry. W1 looks per paired token at every row (the
    reference's order key is non-null on all rows) unless ``base_candidate``
    narrows it; W2 looks globally at rows of pools holding the USD token."""
    cand = base_candidate if base_candidate is not None else F.lit(True)
    usd_rows = F.lit(usd_token).isin(F.col("token0.address"), F.col("token1.address"))
    lookups = [Lookup(f"pairedToken{t}.address", cand, _quote_value(), f"base{t}", include_current=True) for t in ("0", "1")]
    lookups.append(Lookup(None, usd_rows, _quote_value(), "usdBase", include_current=True))
    return look_up(df, lookups, order="logId", chunk_width=chunk_width)


# -- P17-P21: conversions -------------------------------------------------------
# A price as a row's quote gives it: ``times`` (of the quote's base is token 1)
# says whether an amount is multiplied by it or divided. Without a quote a base
# pool's own price serves.


def _priced(amount, price, times):
    """``amount`` (p, q) by a price literal; null without one of them."""
    if amount is None or price is None:
        return None
    return X.mul(amount, X.parse(price)) if times is True else X.div(amount, X.parse(price))


def _quote_or_own(base: Column) -> tuple[Column, Column]:
    """Price and direction of a quote struct, else of the base pool itself."""
    own = base["price"].isNull() & F.coalesce(F.col("isBasePool"), F.lit(False))
    return F.when(own, F.col("price1")).otherwise(base["price"]), F.when(own, F.col("is1")).otherwise(base["is1"])


@arrow_udf(StringType())
def _convert(amount: pa.Array, price: pa.Array, times: pa.Array) -> pa.Array:
    return pa.array([X.fmt(_priced(X.parse(a), p, t)) for a, p, t in zip(X.rows_of(amount), X.rows_of(price), X.rows_of(times), strict=True)], pa.string())


def convert(amount: Column, base: Column) -> Column:
    """``convert(amount, base)`` with ``base`` a quote struct column."""
    return _convert(amount, *_quote_or_own(base))


def convert_by_suffix(name: str) -> Column:
    """``x0`` uses ``base0``, ``x1`` uses ``base1``."""
    return convert(F.col(name), F.col("base" + name[-1]))


#: What the base amounts are called. Fixed values (keys of the published map).
BASE_KEYS = ("volume", "volumeBis", "fee")


@arrow_udf(StructType([StructField(k, StringType()) for k in BASE_KEYS]))
def _base_worths(lead: pa.Array, lead_price: pa.Array, lead_times: pa.Array, other: pa.Array, other_price: pa.Array,
                 other_times: pa.Array, lead_fee: pa.Array, other_fee: pa.Array) -> pa.Array:
    """Volume of the leading side, of the other side, and both fees together,
    in the base token. A direction of null is an amount in that token already."""
    def worths(amount, fee, price, times):
        """Amounts and fees of one side of every row."""
        found = []
        for a, f, p, t in zip(X.rows_of(amount), X.rows_of(fee), X.rows_of(price), X.rows_of(times), strict=True):
            a, f = X.parse(a), X.parse(f)
            if p is None:
                a = f = None
            elif p != "":
                by, one = X.parse(p), X.mul if t is True else X.div
                a, f = one(a, by), one(f, by)
            found.append((a, f))
        return found
    leads, others = worths(lead, lead_fee, lead_price, lead_times), worths(other, other_fee, other_price, other_times)
    columns = [[X.fmt(a) for a, _ in leads], [X.fmt(a) for a, _ in others], [X.fmt(X.add(f, g)) for (_, f), (_, g) in zip(leads, others, strict=True)]]
    return pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], names=list(BASE_KEYS))


def base_amounts(df: DataFrame, base_token: str = ETH_ADDRESS) -> DataFrame:
    """Map of volume, volumeBis and fee in the base token.

    One side leads: the side that is the base token, whose amounts need no
    price, else the side with the newer quote (B4: a missing quote is a null
    ``logId``; side 0 on a tie or without any). ``volume`` is the leading side's,
    ``volumeBis`` the other's, ``fee`` what both sides' fees are worth. The side
    is chosen JVM-side; one Arrow pass works out the three values.
    """
    in_base = [F.coalesce(F.col(f"token{t}.address") == F.lit(base_token), F.lit(False)) for t in "01"]
    newer = F.col("base1.logId").isNotNull() & (F.col("base0.logId").isNull() | (F.col("base0.logId") < F.col("base1.logId")))
    second = ~in_base[0] & (in_base[1] | newer)
    inputs = []
    for leads in (True, False):
        pick = lambda zero, one, leads=leads: F.when(second if leads else ~second, one).otherwise(zero)
        price = [_quote_or_own(F.col(f"base{t}")) for t in "01"]
        own = pick(in_base[0], in_base[1] & ~in_base[0])
        inputs.append((pick(F.col("volume0"), F.col("volume1")), F.when(own, F.lit("")).otherwise(pick(price[0][0], price[1][0])),
                       pick(price[0][1], price[1][1]), pick(F.col("fee0"), F.col("fee1"))))
    (v, p, t, f), (w, q, u, g) = inputs
    out = df.withColumn("__b", _base_worths(v, p, t, w, q, u, f, g))
    entries = [c for k in BASE_KEYS for c in (F.lit(k), F.col(f"__b.{k}"))]
    return out.withColumn("baseAmounts", F.create_map(*entries)).drop("__b")


def _priced_lists(values: pa.Array, price: pa.Array, times: pa.Array) -> tuple[pa.Array, list]:
    """Every value of a row's list by the row's one price: the literals, and the
    rows' (p, q) lists (None for a null list)."""
    flat, at, rows = X.rows_of(values.flatten()), 0, []
    for n, p, t in zip(values.value_lengths().to_pylist(), X.rows_of(price), X.rows_of(times), strict=True):
        if n is None:
            rows.append(None)
            continue
        by, one = None if p is None else X.parse(p), X.mul if t is True else X.div
        rows.append([None] * n if by is None else [one(X.parse(v), by) for v in flat[at:at + n]])
        at += n
    ends = np.cumsum([0, *[0 if r is None else len(r) for r in rows]], dtype=np.int32)
    literals = pa.array([X.fmt(v) for r in rows if r is not None for v in r], pa.string())
    return pa.ListArray.from_arrays(pa.array(ends), literals, mask=pa.array([r is None for r in rows], pa.bool_())), rows


@arrow_udf(ArrayType(StringType()))
def _convert_values(values: pa.Array, price: pa.Array, times: pa.Array) -> pa.Array:
    return _priced_lists(values, price, times)[0]


@arrow_udf(StructType([StructField("values", ArrayType(StringType())), StructField("both", StringType())]))
def _convert_values_and_add(values: pa.Array, price: pa.Array, times: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
    """As ``_convert_values``, and the sum of two of a row's values, by their places from 1."""
    literals, rows = _priced_lists(values, price, times)
    both = [None if not i or not j else X.fmt(X.add(vs[i - 1], vs[j - 1])) for vs, i, j in zip(rows, X.rows_of(one), X.rows_of(other), strict=True)]
    return pa.StructArray.from_arrays([literals, pa.array(both, pa.string())], names=["values", "both"])


def convert_map(amounts: Column, price: Column, times: Column) -> Column:
    """the values of a map of exact amounts, of any keys, converted in one
    Arrow pass; a null map stays null."""
    return F.map_from_arrays(F.map_keys(amounts), _convert_values(F.map_values(amounts), price, times))


#: Gas amounts that join the base amounts before they are converted. Fixed values.
GAS_KEYS = ("gasFees", "tip", "baseFeePerGas")


def usd_amounts(df: DataFrame, usd_token: str = USDC_ADDRESS, gas_keys: Sequence[str] = GAS_KEYS) -> DataFrame:
    """P20: the base amounts with the row's gas amounts (F17; columns of these
    names), each converted to USD: by the own price of a pool of both tokens,
    else by the USD quote, the other way round than into the base token, which
    USD is paired with. ``totalFeesUsd`` = gas fees + pool fee in USD, where the
    map has both."""
    in_usd = (F.col("token0.address") == F.lit(usd_token)) | (F.col("token1.address") == F.lit(usd_token))
    own = F.coalesce(F.col("isBasePool") & in_usd, F.lit(False))
    quote = F.col("usdBase")
    price = F.when(own, F.col("price1")).otherwise(quote["price"])
    times = ~F.coalesce(F.when(own, F.col("is1")).otherwise(quote["is1"]), F.lit(False))
    gas = F.create_map(*[c for k in gas_keys for c in (F.lit(k), F.col(k).cast("string"))])
    amounts = F.map_concat("baseAmounts", gas)
    if "gasFees" not in gas_keys:
        return df.withColumn("usdAmounts", convert_map(amounts, price, times)).withColumn("totalFeesUsd", F.lit(None).cast("string"))
    out = df.withColumn("__amounts", amounts)
    keys = F.map_keys("__amounts")
    places = [F.array_position(keys, k).cast("int") for k in ("gasFees", "fee")]
    out = out.withColumn("__usd", _convert_values_and_add(F.map_values("__amounts"), price, times, *places))
    return out.withColumns({"usdAmounts": F.map_from_arrays(keys, F.col("__usd.values")), "totalFeesUsd": F.col("__usd.both")}).drop("__amounts", "__usd")


@arrow_udf(StructType([StructField("totalFees", StringType()), StructField("totalFeePct", DoubleType())]))
def _fees(gas: pa.Array, fee: pa.Array, vol: pa.Array) -> pa.Array:
    sums = [X.add(X.parse(a), X.parse(b)) for a, b in zip(X.rows_of(gas), X.rows_of(fee), strict=True)]
    parts = [X.to_float(X.div(t, X.parse(v))) for t, v in zip(sums, X.rows_of(vol), strict=True)]
    return pa.StructArray.from_arrays([pa.array(map(X.fmt, sums), pa.string()), pa.array([None if x is None else x * 100 for x in parts], pa.float64())],
                                      names=["totalFees", "totalFeePct"])


def total_fees(df: DataFrame) -> DataFrame:
    """Gas fees + pool fee in base; percent of the base volume when it is not 0."""
    f = _fees(F.col("gasFees"), F.col("baseAmounts")["fee"], F.col("baseAmounts")["volume"])
    return (df.withColumn("__f", f).withColumns({"totalFees": F.col("__f.totalFees"),
                                                 "totalFeePct": F.col("__f.totalFeePct")}).drop("__f"))
