"""Structured Streaming rating: T1-T13.

Two forms:

* ``swap_delta_stream`` (T1, T2, T5, T7-T9): the previous-swap delta as one
  ``applyInPandasWithState`` per pool address, with a watermark on block time
  (1 block = 1 s) and an event-time timeout that drops a pool's state
  ``expiry`` blocks after its last swap.

* ``RatedStream`` (T10-T13): the whole rating chain (delta, base quotes per
  paired token, USD quote, amounts, fees) inside one ``foreachBatch``.
  PySpark allows only one ``applyInPandasWithState`` per query, so state is
  carried explicitly: the rows that later rows can still need (the last swap
  per pool, and every quote, none older than the expiry) are written per
  batch id under the checkpoint dir. Each micro-batch is unioned with the
  previous batch's state rows and rated with the same batch operators. What a
  batch works with, its rows and those after each rating step, is written to
  scratch and deleted with the batch, so disk holds one batch's work. A row
  is late only if it is not after the last swap of its own pool, so pools may
  interleave over batches as keyed topics do: a row sees every quote before
  it that had arrived by its batch. With batches in global order the result
  equals the batch result. Late rows are written to a reject folder, and each
  batch is checked to give as many rows as it took (T8). Output goes through
  the idempotent upsert sink; a replayed batch id reads the same state and
  writes the same rows. A batch whose predecessor's state is gone fails.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import BooleanType, StructType

from tidepool.functions import exact as X
from tidepool.session import BLOCK_EXPIRY, checkpoint_dir

# -- single-step: previous swap per pool --------------------------------------

# block n happens at second n + 1: block 0 must not sit on the initial
# watermark (0), where Spark would drop it as late
EVENT_TIME_ORIGIN = 1

DELTA_STATE = "logId decimal(38,18), price0 string, price1 string, tick long"
DELTA_OUT = ("logId decimal(38,18), address string, lastPrice0 string, lastPrice1 string, priceDelta0 string, "
             "priceDelta1 string, priceDeltaPct0 double, priceDeltaPct1 double, tickDelta long, late boolean")


def _delta_fn(expiry: int):
    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(pdfs), ignore_index=True).sort_values("logId", kind="stable")
        last = state.get if state.exists else None
        out = []
        for r in rows.itertuples(index=False):
            rec = {"logId": r.logId, "address": key[0], "lastPrice0": None, "lastPrice1": None,
                   "priceDelta0": None, "priceDelta1": None, "priceDeltaPct0": None,
                   "priceDeltaPct1": None, "tickDelta": None, "late": False}
            if last is not None and r.logId <= last[0]:
                rec["late"] = True          # T7: not after the state; rejected, state unchanged
                out.append(rec)
                continue
            if last is not None and r.logId - last[0] <= expiry:
                p0, p1 = X.parse(r.price0), X.parse(r.price1)
                l0, l1 = X.parse(last[1]), X.parse(last[2])
                d0, d1 = X.sub(p0, l0), X.sub(p1, l1)
                q0, q1 = X.div(d0, l0), X.div(d1, l1)
                rec.update(lastPrice0=last[1], lastPrice1=last[2], priceDelta0=X.fmt(d0),
                           priceDelta1=X.fmt(d1),
                           priceDeltaPct0=None if q0 is None else X.to_float(q0) * 100,
                           priceDeltaPct1=None if q1 is None else X.to_float(q1) * 100,
                           tickDelta=None if r.tick is None or last[3] is None else int(r.tick - last[3]))
            last = (r.logId, r.price0, r.price1, None if pd.isna(r.tick) else int(r.tick))
            out.append(rec)
        state.update(last)
        # T5: the state times out `expiry` blocks (seconds) after the last swap
        state.setTimeoutTimestamp(int((last[0] + EVENT_TIME_ORIGIN + expiry) * 1000))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in DELTA_OUT.split(", ")])
    return fn


#: The published order key: block number and, below it, position in the block.
ORDER_KEY = "decimal(38,18)"


def swap_delta_stream(stream: DataFrame, *, expiry: int = BLOCK_EXPIRY, key: str = "address",
                      order: str = "logId") -> DataFrame:
    """Stateful previous-swap delta on a stream of swaps (append mode). The
    order key keeps its fraction; event time is its block."""
    s = (stream.withColumn(order, F.col(order).cast(ORDER_KEY))
               .withColumn("blockNumberTs", F.timestamp_seconds(F.floor(order) + EVENT_TIME_ORIGIN))
               .withWatermark("blockNumberTs", f"{expiry} seconds"))
    return (s.groupBy(key)
             .applyInPandasWithState(_delta_fn(expiry), DELTA_OUT, DELTA_STATE, "append",
                                     GroupStateTimeout.EventTimeTimeout))


# -- chain: carried state in foreachBatch ------------------------------------

class RatedStream:
    """foreachBatch rating with carried state; see the module docstring.

    ``rate``: the batch rating chain (DataFrame -> DataFrame) applied to state
    rows + micro-batch rows, or its steps, in order: rows are written after each,
    so that no more than a step's shuffle files exist at once; ``is_quote`` / ``is_usd_quote``: which rows are
    quotes; ``target``: upsert sink path; ``root``: a folder under the shared
    checkpoint dir for state and rejects.
    """

    def __init__(self, spark: SparkSession, *, rate: Callable[[DataFrame], DataFrame] | Sequence[Callable[[DataFrame], DataFrame]],
                 is_quote, is_usd_quote, quote_key: str, target: str, root: str | None = None,
                 expiry: int = BLOCK_EXPIRY, order: str = "logId", pool_key: str = "address",
                 output: Callable[[DataFrame], DataFrame] | None = None, upsert_keys=("date", "logId")):
        self.steps, self.is_quote, self.is_usd_quote = [rate] if callable(rate) else list(rate), is_quote, is_usd_quote
        self.quote_key, self.target, self.expiry, self.order = quote_key, target, expiry, order
        self.pool_key, self.output, self.upsert_keys = pool_key, output, upsert_keys
        self.root = root or f"{checkpoint_dir(spark)}/rated-stream"

    def _state_path(self, batch_id: int) -> str:
        return f"{self.root}/state/{batch_id}"

    def _read_state(self, spark: SparkSession, batch_id: int, schema: StructType) -> DataFrame | None:
        if batch_id == 0:
            return None
        return spark.read.schema(schema).parquet(self._state_path(batch_id - 1))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        from tidepool.sources import sinks
        spark = batch.sparkSession
        scratch = sinks.scratch_path(spark, "rated-batch")
        try:
            with sinks.shuffles_freed(spark):
                self._process(batch, batch_id, scratch)
        finally:
            sinks.discard(spark, scratch)

    def _process(self, batch: DataFrame, batch_id: int, scratch: str) -> None:
        from tidepool.operators.layout import spread
        from tidepool.sources import sinks
        spark = batch.sparkSession
        state = self._read_state(spark, batch_id, StructType(list(batch.schema.fields)).add("__last", BooleanType()))
        columns = batch.columns
        batch = spread(batch)
        if state is None:
            batch = batch.withColumn("__late", F.lit(False))
        else:
            # Rows not after the last swap of their own pool are late
            seen = (state.where("__last").groupBy(F.col(self.pool_key).alias("__pool"))
                         .agg(F.max(self.order).alias("__seen")))
            batch = batch.join(seen, F.col(self.pool_key).eqNullSafe(F.col("__pool")), "left")
            late = F.col("__seen").isNotNull() & (F.col(self.order) <= F.col("__seen"))
            batch = batch.select(*columns, late.alias("__late"))
        batch = sinks.staged_at(batch, f"{scratch}/batch")
        rows = batch.where(~F.col("__late")).select(*columns, F.lit(False).alias("__state"))
        if state is not None:
            # a folder a batch: a replayed batch writes its rejects anew, not twice
            batch.where("__late").select(*columns).write.mode("overwrite").parquet(f"{self.root}/rejected/batch={batch_id}")
            rows = rows.unionByName(state.drop("__last").withColumn("__state", F.lit(True)))
        out = rows
        for k, step in enumerate(self.steps):
            out = step(out)
            if k == len(self.steps) - 1:
                out = out.where(~F.col("__state")).drop("__state")
            out = sinks.staged_at(out, f"{scratch}/step{k}")
            if k:
                sinks.discard(spark, f"{scratch}/step{k - 1}")
        # Rating neither loses nor multiplies rows
        taken, given = rows.where(~F.col("__state")).count(), out.count()
        if taken != given:
            raise ValueError(f"batch {batch_id}: {taken} rows in, {given} rows out")
        sinks.upsert(out if self.output is None else self.output(out), self.target,
                     keys=self.upsert_keys, batch_id=f"b{batch_id}")
        self._write_state(rows, batch_id)

    def _write_state(self, rows: DataFrame, batch_id: int) -> None:
        """The last row per pool (``__last``) and every quote, none older than
        ``expiry`` before the newest row (T5); an order key is one row."""
        o = F.col(self.order)
        cols = [c for c in rows.columns if c != "__state"]
        newest = rows.agg(F.max(o)).first()[0]
        last = rows.groupBy(F.col(self.pool_key).alias("__pool")).agg(F.max(o).alias("__at"))
        quote = F.coalesce(self.is_quote, F.lit(False)) | F.coalesce(self.is_usd_quote, F.lit(False))
        kept = (rows.join(last, F.col(self.pool_key).eqNullSafe(F.col("__pool")) & (o == F.col("__at")), "left")
                    .withColumn("__last", F.col("__at").isNotNull())
                    .where(F.col("__last") | quote)
                    .where(o >= F.lit(newest) - F.lit(self.expiry)))
        kept.select(*cols, "__last").write.mode("overwrite").parquet(self._state_path(batch_id))


# -- P6/P7, T12/T13: stream rows and the trigger choice ------------------------

def to_exchange_rate_row(df: DataFrame) -> DataFrame:
    """Append the typed null columns the stateful steps fill (previous
    prices, deltas, three quotes) and the event time (block n -> second n + 1)."""
    quote = "struct<poolAddress:string,price:string,is1:boolean,logId:decimal(38,18)>"
    nulls = {"lastPrice0": "string", "lastPrice1": "string", "priceDelta0": "string",
             "priceDelta1": "string", "priceDeltaPct0": "double", "priceDeltaPct1": "double",
             "tickDelta": "bigint", "base0": quote, "base1": quote, "usdBase": quote}
    out = df.withColumns({k: F.lit(None).cast(t) for k, t in nulls.items() if k not in df.columns})
    return out.withColumn("blockNumberTs",
                          F.timestamp_seconds(F.col("blockNumber").cast("long") + EVENT_TIME_ORIGIN))


def start(writer, *, live: bool, interval: str = "30 seconds"):
    """Drain what is there and stop (``availableNow``), or keep
    running on a processing-time trigger in live mode. Returns the query;
    a drained query has already terminated."""
    if live:
        return writer.trigger(processingTime=interval).start()
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q
