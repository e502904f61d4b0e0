"""Exact grouped quantiles without gathering a group in one task.

The built-in ``percentile`` merges every distinct value of a group in the
group's final task; a pool-day holding a third of all rows would sit in one
task. Here instead:

1. Stack the value columns and count equal values: one row per (group,
   metric, value) with a count, combined before the shuffle. Gas, ticks and
   tips have few distinct values, so a value that a third of all rows share
   is one row.
2. One global sort on (group, metric, value). Range partitioning samples the
   keys, so a hot group is split over many tasks.
3. Checkpoint the sorted counts with their partition id (reliable checkpoint
   under ``spark.checkpoint.dir``: the borders must not move if a branch is
   recomputed after an executor loss).
4. Per (partition, group, metric): rows counted. A window over these few rows
   per (group, metric) gives the rows before each partition and the group's
   count ``n``; a running sum inside a partition gives each value's ranks.
5. Keep only the values at the target ranks ``floor``/``ceil((n - 1) * p)``
   and interpolate as Spark's ``percentile`` does:
   ``(hi - pos) * v_lo + (pos - lo) * v_hi``.

Null group keys are groups: the joins on them are null-safe.

The result has one row per group with one column per requested quantile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, group: Sequence[str], metrics: dict[str, Column],
                    quantiles: dict[str, tuple[str, float]]) -> DataFrame:
    """``metrics``: name -> double value column; ``quantiles``: output column
    -> (metric name, probability). Returns group columns + output columns."""
    group = list(group)
    names = list(metrics)
    stacked = df.select(*group, F.explode(F.array(*[
        F.struct(F.lit(n).alias("m"), metrics[n].cast("double").alias("v")) for n in names])).alias("x"))
    rows = stacked.select(*group, F.col("x.m").alias("m"), F.col("x.v").alias("v")).where(F.col("v").isNotNull())
    keys = group + ["m"]
    counted = rows.groupBy(*keys, "v").agg(F.count("*").alias("__k"))
    counts = counted.orderBy(*keys, "v").withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True)
    parts = counts.groupBy("__pid", *keys).agg(F.sum("__k").alias("__c"))
    w_before = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("__pid").alias("__p"), *[F.col(k).alias(f"__p_{k}") for k in keys],
                         F.coalesce(F.sum("__c").over(w_before), F.lit(0)).alias("__before"),
                         F.sum("__c").over(Window.partitionBy(*keys)).alias("__n"))
    same = F.col("__pid") == F.col("__p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__p_{k}"))
    up_to = Window.partitionBy("__pid", *keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (counts.withColumn("__end", F.sum("__k").over(up_to)).join(parts, same)
                    .withColumn("__end", F.col("__before") + F.col("__end"))
                    .withColumn("__start", F.col("__end") - F.col("__k")))

    def holds(rank: Column) -> Column:
        return (F.col("__start") <= rank) & (rank < F.col("__end"))
    # positions per probability, as the built-in percentile computes them
    probs = sorted({p for _, p in quantiles.values()})
    pos = {p: (F.col("__n") - 1).cast("double") * F.lit(p) for p in probs}
    wanted = F.lit(False)
    for p in probs:
        wanted = wanted | holds(F.floor(pos[p])) | holds(F.ceil(pos[p]))
    picks = ranked.where(wanted)
    aggs = []
    for out, (m, p) in quantiles.items():
        lo, hi = F.floor(pos[p]), F.ceil(pos[p])
        v_lo = F.max(F.when((F.col("m") == m) & holds(lo), F.col("v")))
        v_hi = F.max(F.when((F.col("m") == m) & holds(hi), F.col("v")))
        n_max = F.max(F.when(F.col("m") == m, F.col("__n")))
        position = (n_max - 1).cast("double") * F.lit(p)
        lo_m, hi_m = F.floor(position), F.ceil(position)
        value = (F.when(lo_m == hi_m, v_lo)
                  .when(v_lo == v_hi, v_lo)
                  .otherwise((hi_m - position) * v_lo + (position - lo_m) * v_hi))
        aggs.append(value.alias(out))
    return picks.groupBy(*group).agg(*aggs)


def positions(df: DataFrame, group: Sequence[str], order: str, out: str = "pos") -> DataFrame:
    """``df`` with each row's place (from 0) in its group by ``order``, without
    gathering a group: one global sort, which range partitioning splits inside a
    hot group, written to scratch with the rows' running numbers; a row's place
    is its number less the first of its group in that partition, plus the rows
    of the group in earlier partitions."""
    from tidepool.sources.sinks import staged
    group = list(group)
    numbered = df.orderBy(*group, order).withColumns({"__pid": F.spark_partition_id(), "__no": F.monotonically_increasing_id()})
    rows = staged(numbered, "sorted")
    parts = rows.groupBy("__pid", *group).agg(F.count("*").alias("__c"), F.min("__no").alias("__first"))
    earlier = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("__pid").alias("__p"), *[F.col(g).alias(f"__p_{g}") for g in group],
                         (F.coalesce(F.sum("__c").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"))
    same = F.col("__pid") == F.col("__p")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__p_{g}"))
    return rows.join(parts, same).withColumn(out, F.col("__no") + F.col("__shift")).select(*df.columns, out)
