"""Scans of raw contract events, tokens, pools and block transactions.

S1-S9, S17-S18, S26, P1, P4-P5, P26. Every reader takes a path (or a
DataFrame) and returns a lazy DataFrame; filters are written so they reach
the Parquet scan as partition filters (``contract``, ``epoch``) or pushed
filters (``event``, ``blockNumber``), and only used columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import exact as X
from tidepool.sources import schemas as S


# -- JSON args -----------------------------------------------------------------

def deserialize_json(json_col: Column, schema) -> tuple[Column, object]:
    """Decode a JSON text column with a declared schema."""
    return F.from_json(json_col, schema), schema


def flatten_args(df: DataFrame, schema, args_col: str = "args") -> DataFrame:
    """P5 + P4: parse ``args``, put its fields next to the other columns, drop it."""
    parsed, schema = deserialize_json(F.col(args_col), schema)
    return (df.withColumn("__map", parsed)
              .select("*", *[F.col("__map").getField(f).alias(f) for f in schema.fieldNames()])
              .drop(args_col, "__map"))


def typed_events(df: DataFrame, schemas: dict | None = None) -> dict:
    """One typed frame per kept event, args flattened with its schema."""
    schemas = schemas or S.EVENT_ARGS
    return {key: flatten_args(df.where((F.col("contract") == key[0]) & (F.col("event") == key[1])),
                              schema)
            for key, schema in schemas.items()}


def typed_structs(df: DataFrame, schemas: dict | None = None) -> DataFrame:
    """S26 in one scan: ``args`` gives way to one nullable struct a kept event,
    ``<contract>_<event>``, filled in that event's rows only. A reader of some
    events decodes only those."""
    schemas = schemas or S.EVENT_ARGS
    mine = {f"{c}_{e}": F.when((F.col("contract") == c) & (F.col("event") == e), F.from_json(F.col("args"), schema)) for (c, e), schema in schemas.items()}
    return df.withColumns(mine).drop("args")


# -- raw event scans -----------------------------------------------------------

def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Raw event log, Parquet partitioned by ``contract`` and ``epoch``."""
    return spark.read.parquet(path)


def factory_events(events: DataFrame) -> DataFrame:
    """PoolCreated rows of the factory contract."""
    return events.where((F.col("contract") == "Factory") & (F.col("event") == "PoolCreated"))


def token_scan(tokens: DataFrame) -> DataFrame:
    """Tokens packed into one struct column ``token``."""
    return tokens.select(F.struct(F.col("symbol"), F.col("decimals").cast("decimal(38,0)").alias("decimals"),
                                  F.col("address")).alias("token"))


def pools(factory: DataFrame, tokens: DataFrame) -> DataFrame:
    """S3 + J1: the pool dimension (address, pool, fee, tickSpacing, token0, token1).

    ``factory``: PoolCreated rows with JSON ``args``; ``tokens``: (symbol,
    decimals, address). Two left joins on the token address; Catalyst/AQE
    broadcasts the token side when its measured size is under the threshold.
    """
    schema = S.EVENT_ARGS[("Factory", "PoolCreated")]
    tok = token_scan(tokens)
    t0 = tok.select(F.col("token").alias("token0"))
    t1 = tok.select(F.col("token").alias("token1"))
    m = factory.select(F.from_json(F.col("args"), schema).alias("map"))
    return (m.join(t0, F.col("map.token0") == F.col("token0.address"), "left")
             .join(t1, F.col("map.token1") == F.col("token1.address"), "left")
             .select(F.col("map.pool").alias("address"),
                     pool_name(F.col("token0.symbol"), F.col("token1.symbol"),
                               F.col("map.fee")).alias("pool"),
                     F.col("map.fee").alias("fee"),
                     F.col("map.tickSpacing").alias("tickSpacing"),
                     F.col("token0"), F.col("token1")))


def pool_name(symbol0: Column, symbol1: Column, fee: Column) -> Column:
    """``SYM0_SYM1_<fee in basis points>``; missing symbols are skipped."""
    return F.concat_ws("_", symbol0, symbol1, (fee / F.lit(100)).cast("int"))


def swaps(events: DataFrame, epoch: int, block_expiry: int, epoch_length: int) -> DataFrame:
    """S4 + P1: Swap rows of this epoch and the look-back part of the previous one.

    B3: the look-back starts at ``epoch * length - expiry`` (the reference
    keeps the whole previous epoch; ratings of the current epoch are the same).
    """
    start = epoch * epoch_length - block_expiry
    df = (events.where(F.col("contract") == "Pool")
                .where(F.col("epoch").between(epoch - 1, epoch))
                .where(F.col("blockNumber") >= start)
                .where(F.col("event") == "Swap"))
    return flatten_args(df, S.swap_args_schema())


# -- blocks and transactions ---------------------------------------------------

def expand(blocks: DataFrame, wei_exponent: int = 18) -> DataFrame:
    """One row per transaction with gas price, base fee, gas fee and tip.

    Amounts become exact literals (wei -> ether by the ``e18`` scale); a
    missing base fee gives a null base fee and tip (``concat`` of null).
    """
    suffix = F.lit(f"e{wei_exponent}")
    tx = blocks.select(F.col("blockNumber"), F.col("timestamp"), F.col("baseFeePerGas"),
                       F.explode("transactions").alias("transaction"))
    out = tx.select(
        F.col("blockNumber"), F.col("timestamp"),
        F.col("transaction.hash").alias("transactionHash"),
        F.col("transaction.gas").alias("gas"),
        F.concat(F.col("transaction.gasPrice").cast("string"), suffix).alias("gasPrice"),
        F.concat(F.col("baseFeePerGas").cast("string"), suffix).alias("baseFeePerGas"))
    return with_gas_amounts(out, wei_exponent)


def with_gas_amounts(df: DataFrame, wei_exponent: int) -> DataFrame:
    """Gas fees (gas times gas price) and tip (gas price less base fee). Prices
    of whole wei (``<digits>e<wei_exponent>``) of up to 18 digits are built-in
    decimal arithmetic; only others go through Python."""
    suffix = F.lit(f"e{wei_exponent}")
    wei = lambda c: F.when(F.endswith(c, suffix) & (F.length(c) <= 18 + len(f"e{wei_exponent}")),
                           F.left(F.col(c), F.length(c) - len(f"e{wei_exponent}")).try_cast("decimal(18,0)"))
    plain = lambda c: F.translate(c, "0123456789e", "") == ""
    price, base = (F.when(plain(c), wei(c)) for c in ("gasPrice", "baseFeePerGas"))
    gas = F.col("gas").cast("string")
    amount = F.when((F.translate(gas, "0123456789", "") == "") & (F.length(gas) <= 18), gas.try_cast("decimal(18,0)"))
    lanes = df.withColumns({"__fees": X.decimal_literal(amount * price, F.lit(wei_exponent)), "__tip": X.decimal_literal(price - base, F.lit(wei_exponent))})
    fees, tip = F.col("__fees"), F.col("__tip")
    rest = lambda lane, c: F.when(lane.isNull(), c)
    return (lanes.withColumn("gasFees", F.coalesce(fees, X.mul_(rest(fees, gas), rest(fees, F.col("gasPrice")))))
                 .withColumn("tip", F.coalesce(tip, X.sub_(rest(tip, F.col("gasPrice")), rest(tip, F.col("baseFeePerGas")))))
                 .drop("__fees", "__tip"))


def blocks_with_lookback(blocks: DataFrame, epoch: int, block_expiry: int,
                         epoch_length: int) -> DataFrame:
    """Blocks of ``epoch`` and the look-back tail of ``epoch - 1``.

    The declared schema keeps ``baseFeePerGas`` nullable, so both epochs are
    one scan with a partition filter (no per-epoch read).
    """
    start = epoch * epoch_length - block_expiry
    return (blocks.withColumnRenamed("number", "blockNumber")
                  .where(F.col("epoch").between(epoch - 1, epoch))
                  .where(F.col("blockNumber") >= start))


def transactions(blocks: DataFrame, epoch: int, block_expiry: int, epoch_length: int,
                 wei_exponent: int = 18) -> DataFrame:
    """Expanded transactions of the epoch plus the look-back."""
    return expand(blocks_with_lookback(blocks, epoch, block_expiry, epoch_length), wei_exponent)


def lookback_epochs(blocks: DataFrame, epoch_length: int, block_expiry: int,
                    epoch_col: str = "epoch", block_col: str = "blockNumber") -> DataFrame:
    """S5/S7 over all epochs at once: ``ratingEpoch`` is the row's epoch, and
    rows in the last ``block_expiry`` blocks of an epoch are also copied to
    the next one (its look-back), so every epoch's input is one filter away
    and no driver loop over epochs is needed."""
    nxt = F.col(epoch_col) + 1
    tail = F.col(block_col) >= nxt.cast("long") * epoch_length - block_expiry
    return blocks.withColumn("ratingEpoch", F.explode(
        F.when(tail, F.array(F.col(epoch_col), nxt)).otherwise(F.array(F.col(epoch_col)))))


def union_epochs(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column missing in one epoch becomes null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# -- SQL path scans and pool start records ------------------------------------

def sql_path_scan(spark: SparkSession, path: str, where: str | None = None,
                  fmt: str = "parquet") -> DataFrame:
    """``SELECT * FROM parquet.`path` [WHERE ...]``."""
    q = f"SELECT * FROM {fmt}.`{path}`"
    if where:
        q += f" WHERE {where}"
    return spark.sql(q)


def filtered_dataset(spark: SparkSession, path: str, epoch: int, event: str = "PoolCreated",
                     schema=None) -> DataFrame:
    """Dataset rows with ``epoch < n`` and the event; a missing path is an
    empty frame with the declared schema instead of an error."""
    schema = schema or S.RAW_EVENTS
    try:
        df = spark.read.schema(schema).parquet(path)
        df.schema  # resolve now: a missing path raises here
    except Exception as e:  # noqa: BLE001 - path absence is the expected case
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        df = spark.createDataFrame([], schema)
    return df.where((F.col("epoch") < epoch) & (F.col("event") == event))


def pool_start_records(old: DataFrame, new: DataFrame) -> DataFrame:
    """P26 + U3: (address, startBlock, name) of old and new PoolCreated rows.

    Duplicates are kept, as the reference concatenates both sides.
    """
    both = union_epochs([old.drop("epoch") if "epoch" in old.columns else old,
                         new.drop("epoch") if "epoch" in new.columns else new])
    return both.select(F.get_json_object(F.col("args"), "$.pool").alias("address"),
                       F.col("blockNumber").alias("startBlock"),
                       F.lit("Pool").alias("name"))
