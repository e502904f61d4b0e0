"""Latest earlier row per key, with an optional expiry.

One operator covers the as-of quote joins, the deprecated rolling quotes and
the previous-swap delta, without any window spanning a whole key. The order key
is cut into chunks and one window per (key, chunk) finds the latest candidate
inside the chunk. How candidates of earlier chunks get there depends on the
chunk's width, which is free: ``density_width`` takes it from the rows.

*Wide chunks* (the expiry or more): every candidate in the last ``expiry`` of
its chunk is copied into the next chunk in the same pass. One shuffle, no join.

*Narrow chunks* (dense data, or no expiry): the last candidate of every (key,
chunk) is aggregated from a narrow scan, for all look-ups at once and combined
before the shuffle, carried to the later chunks that it can still reach, and
written to scratch; the windows' output is joined with it on (key, chunk), the
partitioning it has already. With an expiry a candidate reaches a bounded number
of chunks; without one it is carried through blocks of chunks and then over the
blocks, so that no window holds more than a block of summary rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNK = "__chunk"


def _key_cols(key: str | Sequence[str] | None) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def _internal_key(keys: list[str]) -> Column:
    """One non-null, injective string key: a null key stays a group of its own
    and joins by plain equality (no null-safe rewrite that would reshuffle)."""
    if not keys:
        return F.lit("")
    parts = [F.when(F.col(k).isNull(), F.lit("N")).otherwise(F.concat(F.lit("V"), F.col(k).cast("string")))
             for k in keys]
    return parts[0] if len(parts) == 1 else F.concat_ws("\u0001", *parts)


@dataclass(frozen=True)
class Lookup:
    """``out``: ``value`` of the latest candidate row of the same key.

    ``candidate``: boolean, which rows can be picked.
    ``value``: struct to carry; it must hold the order key under its own name,
    so that the expiry can be tested.
    ``include_current``: frame ends at the current row (W1/W2) instead of
    one row before (J4-J6, W3).
    ``expiry``: gap (in order units) above which the value is dropped.
    ``self_excluded``: a candidate row gets null (a quote row shows no quote).
    """

    key: str | Sequence[str] | None
    candidate: Column
    value: Column
    out: str
    include_current: bool = False
    expiry: float | None = None
    self_excluded: bool = False

    def checked(self, order: str, found: Column, is_candidate: Column) -> Column:
        """``found`` less what the expiry or the row itself rule out."""
        if self.expiry is not None:
            found = F.when(F.col(order) - found[order] <= F.lit(self.expiry), found)
        return F.when(~is_candidate, found) if self.self_excluded else found


def latest_before(df: DataFrame, *, key: str | Sequence[str] | None, order: str,
                  candidate: Column, value: Column, out: str,
                  include_current: bool = False, expiry: float | None = None,
                  self_excluded: bool = False, chunk_width: float = 10000) -> DataFrame:
    """Add ``out``; the arguments are ``Lookup``'s."""
    return look_up(df, [Lookup(key, candidate, value, out, include_current, expiry, self_excluded)],
                   order=order, chunk_width=chunk_width)


def look_up(df: DataFrame, lookups: Sequence[Lookup], *, order: str, chunk_width: float) -> DataFrame:
    """Add the ``out`` of every look-up. Candidates, values and keys are columns
    of ``df`` itself, not outputs of other look-ups."""
    reaching = [i for i, x in enumerate(lookups) if x.expiry is None or x.expiry > chunk_width]
    carry = _carries(df, lookups, reaching, order, chunk_width) if reaching else None
    rows = df
    for i, x in enumerate(lookups):
        rows = _carried(rows, i, x, carry, order, chunk_width) if i in reaching else _copied(rows, i, x, order, chunk_width)
    return rows.drop(*[x.out for x in lookups]).withColumnsRenamed({f"__out{i}": x.out for i, x in enumerate(lookups)})


def _parts(i: int, x: Lookup) -> dict[str, Column]:
    """A look-up's key, candidate flag and value."""
    return {f"__key{i}": _internal_key(_key_cols(x.key)), f"__is{i}": F.coalesce(x.candidate, F.lit(False)), f"__value{i}": F.when(x.candidate, x.value)}


def _chunk(order: str, width: float) -> Column:
    return F.floor(F.col(order) / F.lit(float(width))).cast("long")


def _frame(i: int, x: Lookup, order: str) -> Window:
    return (Window.partitionBy(f"__key{i}", _CHUNK).orderBy(F.col(order))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow if x.include_current else -1))


def _copied(rows: DataFrame, i: int, x: Lookup, order: str, width: float) -> DataFrame:
    """Wide chunks: a copy made in the same pass (explode) takes a candidate
    into the next chunk; it keeps only what the window needs."""
    parts = _parts(i, x)
    rows = rows.withColumns(parts)
    needed = (order, *parts)
    chunk = _chunk(order, width)
    in_tail = F.col(order) >= (chunk + 1) * F.lit(float(width)) - F.lit(x.expiry)
    dup = rows.withColumns({_CHUNK: chunk, "__copy": F.explode(
        F.when(F.col(f"__is{i}") & in_tail, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))})
    # as text: one call for all columns
    name = {c: "`" + c.replace("`", "``") + "`" for c in rows.columns}
    both = dup.selectExpr(*[n if c in needed else f"IF(__copy, NULL, {n}) AS {n}" for c, n in name.items()],
                          f"{_CHUNK} + CAST(__copy AS BIGINT) AS {_CHUNK}", "NOT __copy AS __orig")
    found = both.withColumn("__found", F.last(F.col(f"__value{i}"), ignorenulls=True).over(_frame(i, x, order))).where("__orig")
    return found.withColumn(f"__out{i}", x.checked(order, F.col("__found"), F.col(f"__is{i}"))).drop(*parts, _CHUNK, "__orig", "__found")


#: Chunks of a block: look-ups without an expiry are carried by blocks.
BLOCK = 1024


def _carries(df: DataFrame, lookups: Sequence[Lookup], which: list[int], order: str, width: float) -> DataFrame:
    """lookup, key, chunk and, per look-up, the latest value before the chunk:
    from one scan, written to scratch. ``lookup`` is a column, so the constant
    key of a global look-up makes no single-partition window either."""
    from tidepool.sources.sinks import scratch_path
    ready = df.withColumns({k: c for i in which for k, c in _parts(i, lookups[i]).items()})
    entry = {i: F.struct(F.lit(i).alias("lookup"), F.col(f"__key{i}").alias("key")) for i in which}
    # with an expiry only candidates count; without, every chunk needs its carry
    wanted = [F.when(F.col(f"__is{i}") | F.lit(lookups[i].expiry is None), entry[i]) for i in which]
    long = (ready.select(order, _chunk(order, width).alias(_CHUNK), *[f"__value{i}" for i in which],
                         F.explode(F.array_compact(F.array(*wanted))).alias("__of"))
            .withColumns({"lookup": F.col("__of.lookup"), "key": F.col("__of.key")}))
    value = {i: F.when(F.col("lookup") == i, F.col(f"__value{i}")) for i in which}
    last = long.groupBy("lookup", "key", _CHUNK).agg(
        *[F.max_by(value[i], F.when(value[i].isNotNull(), F.col(order))).alias(f"__value{i}") for i in which])
    parts = []
    expiring = [i for i in which if lookups[i].expiry is not None]
    if expiring:
        reach = F.coalesce(*[F.floor((F.col(f"__value{i}")[order] + F.lit(lookups[i].expiry)) / F.lit(float(width))).cast("long") for i in expiring])
        far = F.when(reach > F.col(_CHUNK), F.sequence(F.col(_CHUNK) + 1, reach))
        ahead = last.where(F.col("lookup").isin(expiring)).withColumn("__to", F.explode(far))
        parts.append(ahead.groupBy("lookup", "key", F.col("__to").alias(_CHUNK)).agg(
            *[F.max_by(F.col(f"__value{i}"), F.when(F.col(f"__value{i}").isNotNull(), F.col(_CHUNK))).alias(f"__value{i}") for i in which]))
    if len(expiring) < len(which):
        held = last.where(~F.col("lookup").isin(expiring)).withColumn("__block", F.floor(F.col(_CHUNK) / BLOCK))
        earlier = lambda c, w: F.last(F.col(c), ignorenulls=True).over(w)
        inner = Window.partitionBy("lookup", "key", "__block").orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        outer = Window.partitionBy("lookup", "key").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
        of_block = held.groupBy("lookup", "key", "__block").agg(
            *[F.max_by(F.col(f"__value{i}"), F.when(F.col(f"__value{i}").isNotNull(), F.col(_CHUNK))).alias(f"__value{i}") for i in which])
        before = of_block.select("lookup", "key", "__block", *[earlier(f"__value{i}", outer).alias(f"__before{i}") for i in which])
        inside = held.select("lookup", "key", _CHUNK, "__block", *[earlier(f"__value{i}", inner).alias(f"__value{i}") for i in which])
        parts.append(inside.join(before, ["lookup", "key", "__block"]).select(
            "lookup", "key", _CHUNK, *[F.coalesce(f"__value{i}", f"__before{i}").alias(f"__value{i}") for i in which]))
    found = reduce(DataFrame.unionByName, parts)
    path = scratch_path(df.sparkSession, "carry")
    found.where(reduce(Column.__or__, [F.col(f"__value{i}").isNotNull() for i in which])).write.parquet(path)
    return df.sparkSession.read.schema(found.schema).parquet(path)


def _carried(rows: DataFrame, i: int, x: Lookup, carry: DataFrame, order: str, width: float) -> DataFrame:
    """Narrow chunks: the window's own find, else what was carried here."""
    parts = _parts(i, x)
    own = rows.withColumns(parts | {_CHUNK: _chunk(order, width)})
    inside = own.withColumn("__found", F.last(F.col(f"__value{i}"), ignorenulls=True).over(_frame(i, x, order)))
    mine = carry.where(F.col("lookup") == i).select(F.col("key").alias(f"__key{i}"), _CHUNK, F.col(f"__value{i}").alias("__carry"))
    joined = inside.join(mine, [f"__key{i}", _CHUNK], "left")
    found = F.coalesce(F.col("__found"), F.col("__carry"))
    return joined.withColumn(f"__out{i}", x.checked(order, found, F.col(f"__is{i}"))).drop(*parts, _CHUNK, "__found", "__carry")


def density_width(rows: DataFrame, order: str, span: float, per_chunk: int = 1_000_000) -> float:
    """Chunk width with at most about ``per_chunk`` rows in a chunk, at most
    ``span``: from counts by ``span``, one narrow scan, of which the driver gets
    the largest."""
    most = rows.groupBy(F.floor(F.col(order) / F.lit(float(span)))).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    return float(span) if most <= per_chunk else float(span) * per_chunk / most


def quote_struct(address: Column, price: Column, is1: Column, log_id: Column) -> Column:
    """The quote carried by the as-of operators: ``Base(poolAddress, price, is1, logId)``."""
    return F.struct(address.alias("poolAddress"), price.alias("price"),
                    is1.alias("is1"), log_id.alias("logId"))
