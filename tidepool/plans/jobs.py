"""The two published jobs on reference-shaped inputs.

``rated_swaps``: raw contract events (``contract``/``epoch`` partitioned,
JSON ``args``), blocks with nested transactions and a token table ->
one row per swap, rated. ``day_swaps``: rated swaps -> one row per pool and
day. ``epoch=None`` rates every epoch of the input in one pass (no per-epoch
loop); an epoch number rates that epoch with its look-back, as one run of
the reference does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators import asof, daily, enrich, rate
from tidepool.session import BLOCK_EXPIRY, EPOCH_LENGTH, ETH_ADDRESS, USDC_ADDRESS
from tidepool.sources import events as src
from tidepool.sources import schemas as S
from tidepool.sources import sinks


def _swaps(events: DataFrame, epoch, block_expiry, epoch_length) -> DataFrame:
    if epoch is not None:
        return src.swaps(events, epoch, block_expiry, epoch_length)
    rows = events.where((F.col("contract") == "Pool") & (F.col("event") == "Swap"))
    return src.flatten_args(rows, S.swap_args_schema())


def _transactions(blocks: DataFrame, epoch, block_expiry, epoch_length, wei_exponent) -> DataFrame:
    if epoch is not None:
        return src.transactions(blocks, epoch, block_expiry, epoch_length, wei_exponent)
    return src.expand(blocks.withColumnRenamed("number", "blockNumber"), wei_exponent)


def rated_swaps(events: DataFrame, blocks: DataFrame, tokens: DataFrame, *, epoch: int | None = None,
                block_expiry: int = BLOCK_EXPIRY, epoch_length: int = EPOCH_LENGTH,
                base_token: str = ETH_ADDRESS, usd_token: str = USDC_ADDRESS,
                chunk_width: int | None = None, wei_exponent: int = 18) -> DataFrame:
    """Sources, joins, per-swap enrichment, delta, quotes, amounts and fees.

    The chunk width (the span of one window partition, so the work of one task
    for a hot key) follows the density of the swaps unless it is given: from a
    narrow count of swap events by block. Where it comes out narrower than the
    expiry, the enriched rows are written once and the four look-ups share one
    narrow scan of them.
    """
    swaps = _swaps(events, epoch, block_expiry, epoch_length)
    width = chunk_width or asof.density_width(swaps, "blockNumber", block_expiry)
    pools = src.pools(src.factory_events(events), tokens)
    txs = _transactions(blocks, epoch, block_expiry, epoch_length, wei_exponent)
    s = enrich.join_swaps(swaps, txs, pools)
    s = enrich.with_log_id(s)
    s = enrich.swap_price(s)
    s = enrich.swap_volume(s)
    s = enrich.tick_liquidity(s)
    s = enrich.exchange_rate_prep(s, base_token=base_token)
    if width < block_expiry:
        s = sinks.staged(s, "enriched")
    s = rate.delta_and_quotes(s, base_token=base_token, usd_token=usd_token, expiry=block_expiry, chunk_width=width)
    if epoch is not None:
        s = s.where(F.col("epoch") == epoch)          # P2: drop the look-back epoch
    s = rate.base_amounts(s, base_token=base_token)
    s = rate.total_fees(s)
    s = rate.usd_amounts(s, usd_token=usd_token)
    return s.withColumn("date", F.date_format(F.timestamp_seconds(F.col("timestamp")), "yyyy-MM-dd"))


def write_rated_swaps(rated: DataFrame, path: str, batch_id=None) -> None:
    """Upsert into the date-partitioned table on (date, logId)."""
    sinks.upsert(rated, path, keys=("date", "logId"), batch_id=batch_id)


def day_swaps(rated: DataFrame, dates: list[str] | None = None) -> DataFrame:
    """S13 + A29: the pool-day table for the given dates (all if None)."""
    r = rated if dates is None else rated.where(F.col("date").isin(dates))
    return daily.pool_day_stats(daily.day_tags(r))


def write_day_swaps(days: DataFrame, path: str) -> None:
    """Overwrite exactly the dates written."""
    sinks.overwrite_partitions(days, path, "date")
