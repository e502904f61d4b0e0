"""Golden values, as value equality. Literals, addresses, prices and results in
this file are fixed values: results must equal them."""

from decimal import Decimal

from pyspark.sql import functions as F

from tidepool.functions import exact as X
from tidepool.operators import rate
from tidepool.session import BLOCK_EXPIRY, ETH_ADDRESS, USDC_ADDRESS

TOK = "struct<symbol:string,decimals:decimal(38,0),address:string>"
QUOTE = "struct<poolAddress:string,price:string,is1:boolean,logId:decimal(38,18)>"


def tok(sym, dec, addr):
    return (sym, Decimal(dec), addr)


def test_exact_literals():
    assert X.fmt(X.mul(X.parse("1"), X.parse("2"))) == "2e0b0/1e0b0"
    assert X.fmt(X.sub(X.parse("0.5"), X.parse("1"))) == "-5e1b0/1e0b0"
    assert X.fmt(X.sub(X.parse("2"), X.parse("1"))) == "1e0b0/1e0b0"
    # reciprocal of M e-2 b192 equals 1e2b0 / M e0 b192
    m = "2645809970288966871220430322152061218317819773293375026117264"
    assert X.div(X.parse("1"), X.parse(f"{m}e-2b192/1e0b0")) == X.parse(f"1e2b0/{m}e0b192") or \
        X.reduce(*X.div(X.parse("1"), X.parse(f"{m}e-2b192/1e0b0"))) == \
        X.reduce(*X.parse(f"1e2b0/{m}e0b192"))
    assert X.to_text(X.parse("6e0b0/5e0b0")) == "1.2"
    assert X.parse("2026966802000e14b0/1e0b0") == (2026966802000, 10 ** 14)


def test_limbs_round_trip():
    for s in ["0", "1", "-1", "0.5", "-123.456", "12345678901234567890.000000001", "1e0b0/3e0b0"]:
        v = X.parse(s)
        blocks = X.to_blocks(v)
        back = X.from_blocks(blocks.pop(0, [0] * X.N_LIMBS), blocks.items())
        assert abs(X.to_float(X.sub(back, v))) < 1e-70
    # order preserving
    vals = ["-5", "-0.5", "0", "1e9", "0.25", "-1e30b0/1e0b0"]
    keyed = sorted(vals, key=lambda s: X.order_key(X.parse(s)))
    assert keyed == sorted(vals, key=lambda s: X.to_float(X.parse(s)))


def test_weighted_price_golden(spark):
    from tidepool.operators.daily import liquidity_weighted_price
    df = spark.createDataFrame([(1, "2", "1"), (4, "1", "1")], "tickDepth int, price string, liquidity string")
    out = df.agg(X.resolve_text(liquidity_weighted_price(F.col("tickDepth"), F.col("price"))).alias("v"))
    assert out.first()["v"] == "1.2"


def test_base_pool_fee_golden(spark):
    df = spark.createDataFrame([(True, True, "1", "2")], "isBasePool boolean, is1 boolean, fee0 string, price1 string")
    df = df.withColumn("base0", F.struct(F.lit(None).cast("string").alias("price"),
                                         F.lit(None).cast("boolean").alias("is1")))
    assert df.select(rate.convert_by_suffix("fee0").alias("v")).first()["v"] == "2e0b0/1e0b0"


def test_conversion_chain_golden(spark):
    row = (
        tok("WBTC", 8, "0x2260FAC5E5542a773Aa44fBCfeDf7C193bc2C599"),
        tok("USDT", 6, "0xdAC17F958D2ee523a2206206994597C13D831ec7"),
        "1e2b0/2645809970288966871220430322152061218317819773293375026117264e0b192",
        "2645809970288966871220430322152061218317819773293375026117264e-2b192/1e0b0",
        "6099198000e14b0/1e0b0", "0",
        "2026966802000e14b0/1e0b0", "854403634e6b0/1e0b0",
        ("0x4585FE77225b41b697C938B018E2Ac67Ac5a20c0",
         "907334895169304099592376346996265340613152495870046552845371787198225e10b192/1e0b0",
         True, Decimal("13320818.000860013300000000")),
        ("0x11b815efB8f581194ae79006d24E0d814B7697F6",
         "18322227182269616037841953581097896229670063757649e-12b192/1e0b0",
         False, Decimal("13320829.001810022500000000")),
        (" 0x88e6A0c2dDD26FEEb64F039a2c41296FcB3f5640",
         "2148930618079446334171198021437466595445357402245217269710901634724e12b192/1e0b0",
         True, Decimal("13320830.000340003800000000")),
        "18608586517127222e18b0/1e0b0", "1825346000e18b0/1e0b0", "104818396254e18", False, None)
    schema = (f"token0 {TOK}, token1 {TOK}, price0 string, price1 string, fee0 string, fee1 string, "
              f"volume0 string, volume1 string, base0 {QUOTE}, base1 {QUOTE}, usdBase {QUOTE}, "
              "gasFees string, tip string, baseFeePerGas string, isBasePool boolean, is1 boolean")
    df = spark.createDataFrame([row], schema)
    out = rate.usd_amounts(rate.base_amounts(df))
    v = out.select(X.resolve(X.div_(F.col("usdAmounts")["volume"], F.col("volume1"))).alias("v")).first()["v"]
    assert abs(v - 1.0) < 0.001


def _stream_row(log_id, address, price1, is1, is_base, t0, t1, p0, p1):
    return (Decimal(log_id), log_id, address, price1, is1, is_base, t0, t1, p0, p1)


def test_asof_quotes_golden(spark):
    none = tok("", 0, "")
    x, y = tok("X", 0, "x"), tok("Y", 0, "y")
    eth, usdc = tok("ETH", 18, ETH_ADDRESS), tok("USDC", 6, USDC_ADDRESS)
    rows = [
        _stream_row(0, "a", "1", False, True, eth, x, x, x),
        _stream_row(1, "d", "0.5", False, True, eth, usdc, usdc, usdc),
        _stream_row(2, "b", "2", None, False, x, y, x, y),
        _stream_row(3, "a", "1.5", False, True, eth, x, x, x),
        _stream_row(4, "c", "2", None, False, y, x, y, x),
        _stream_row(5, "b", "2", None, False, x, y, x, y),
        _stream_row(BLOCK_EXPIRY + 6, "b", "2", None, False, x, y, x, y),
    ]
    del none
    schema = (f"logId decimal(38,18), blockNumber long, address string, price1 string, is1 boolean, "
              f"isBasePool boolean, token0 {TOK}, token1 {TOK}, pairedToken0 {TOK}, pairedToken1 {TOK}")
    df = spark.createDataFrame(rows, schema)
    out = rate.usd_exchange_rate(rate.base_exchange_rate(df, chunk_width=3), chunk_width=3)
    got = {int(r["blockNumber"]): (r["b0"], r["b1"], r["u"]) for r in out.select(
        "blockNumber", F.col("base0.logId").cast("int").alias("b0"),
        F.col("base1.logId").cast("int").alias("b1"),
        F.col("usdBase.logId").cast("int").alias("u")).collect()}
    assert got == {0: (None, None, None), 1: (None, None, None), 2: (0, None, 1),
                   3: (None, None, 1), 4: (None, 3, 1), 5: (3, None, 1),
                   BLOCK_EXPIRY + 6: (None, None, None)}
    q = out.where("blockNumber = 4").select("base1.*").first()
    assert (q["poolAddress"], q["price"], q["is1"]) == ("a", "1.5", False)


def test_swap_delta_golden(spark):
    rows = [("a", 0, "1", "1", 0), ("b", 1, "1", "1", 5), ("a", 2, "0.5", "2", 1),
            ("b", 3, "0.5", "2", 2), ("a", 4, "1", "1", 0)]
    df = spark.createDataFrame(rows, "address string, logId int, price0 string, price1 string, tick long")
    df = df.withColumn("logId", F.col("logId").cast("decimal(38,18)"))
    out = rate.swap_delta(df, chunk_width=2)
    got = {int(r["logId"]): r for r in out.collect()}
    assert got[0]["lastPrice0"] is None and got[1]["priceDelta0"] is None
    for i in (2, 3):
        r = got[i]
        assert (r["lastPrice0"], r["lastPrice1"]) == ("1", "1")
        assert (r["priceDelta0"], r["priceDelta1"]) == ("-5e1b0/1e0b0", "1e0b0/1e0b0")
        assert (r["priceDeltaPct0"], r["priceDeltaPct1"]) == (-50.0, 100.0)
    assert got[2]["tickDelta"] == 1 and got[3]["tickDelta"] == -3
    r = got[4]
    assert (r["lastPrice0"], r["lastPrice1"]) == ("0.5", "2")
    assert (r["priceDelta0"], r["priceDelta1"]) == ("5e1b0/1e0b0", "-1e0b0/1e0b0")
    assert (r["priceDeltaPct0"], r["priceDeltaPct1"], r["tickDelta"]) == (100.0, -50.0, -1)
