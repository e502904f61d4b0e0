"""Data checks as Spark jobs: Q1-Q8, A30-A36, J8, J9, O4.

Each check returns a small report DataFrame (per period or per key); no
check collects data rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sides(benchmark: DataFrame, challenger: DataFrame) -> DataFrame:
    """Rows of both datasets with a count of each side."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    mark = lambda df, x, y: df.select(*benchmark.columns, x.alias("__b"), y.alias("__c"))
    return mark(benchmark, one, none).unionByName(mark(challenger, none, one))


def reconcile(benchmark: DataFrame, challenger: DataFrame, period: str) -> DataFrame:
    """Per period, the row counts of both datasets and the
    distinct count of their union; equal counts everywhere mean the same
    rows (as sets). Nulls are equal. One scan of either side: equal rows are
    counted by side, combined before the shuffle, and the counts summed."""
    rows = _sides(benchmark, challenger).groupBy(*benchmark.columns).agg(F.sum("__b").alias("__b"), F.sum("__c").alias("__c"))
    some = lambda c: F.nullif(F.sum(c), F.lit(0).cast("long"))
    rep = rows.groupBy(period).agg(some("__b").alias("benchmarkRows"), some("__c").alias("challengerRows"), F.count("*").alias("distinctRows"))
    same = (F.col("benchmarkRows") == F.col("challengerRows")) & (F.col("benchmarkRows") == F.col("distinctRows"))
    return rep.withColumn("identical", F.coalesce(same, F.lit(False)).cast("string"))


def fingerprints(benchmark: DataFrame, challenger: DataFrame, period: str) -> DataFrame:
    """Per period, each side's row count and whether both hold the same rows
    (as multisets), by order-free sums of two 64-bit hashes of the rows. Rows are
    hashed where they are read; only a row a period and task is shuffled."""
    both, cols = _sides(benchmark, challenger), benchmark.columns
    # a null must not be skipped by the hash of a row: its place is marked
    marks = [F.col(c).isNull() for c in cols]
    sign = F.col("__b") - F.col("__c")
    diff = [F.sum(sign.cast("decimal(20,0)") * F.xxhash64(*cols, *marks, F.lit(seed)).cast("decimal(20,0)")) for seed in (1, 2)]
    rep = both.groupBy(period).agg(F.sum("__b").alias("benchmarkRows"), F.sum("__c").alias("challengerRows"), ((diff[0] == 0) & (diff[1] == 0)).alias("__same"))
    same = F.col("__same") & (F.col("benchmarkRows") == F.col("challengerRows"))
    return rep.withColumn("identical", F.coalesce(same, F.lit(False)).cast("string")).drop("__same")


def differences(benchmark: DataFrame, challenger: DataFrame, period: str) -> DataFrame:
    """The rows that occur in one side more often than in the other, with both
    counts: only periods whose fingerprints differ are compared row by row."""
    unequal = fingerprints(benchmark, challenger, period).where("identical = 'false'").select(F.col(period).alias("__period"))
    left, right = (df.join(unequal, F.col(period).eqNullSafe(F.col("__period")), "left_semi") for df in (benchmark, challenger.select(*benchmark.columns)))
    rows = _sides(left, right).groupBy(*benchmark.columns).agg(F.sum("__b").alias("benchmarkRows"), F.sum("__c").alias("challengerRows"))
    return rows.where(F.col("benchmarkRows") != F.col("challengerRows"))


def range_join(points: DataFrame, ranges: DataFrame, point: str, lo: str, hi: str,
               width: int) -> DataFrame:
    """J8 at scale: ``point BETWEEN lo AND hi`` as an equi-join on buckets of
    ``width``: each range is exploded into the buckets it covers, each point
    falls in one bucket, then the bounds are tested. Ranges wider than many
    buckets cost one row per covered bucket (a day of blocks covers one or
    two)."""
    r = ranges.withColumn("__b", F.explode(F.sequence(
        F.floor(F.col(lo) / width).cast("long"), F.floor(F.col(hi) / width).cast("long"))))
    p = points.withColumn("__b", F.floor(F.col(point) / width).cast("long"))
    return (p.join(r, "__b").where(F.col(point).between(F.col(lo), F.col(hi))).drop("__b"))


def in_out(swaps: DataFrame, blocks: DataFrame, day_stats: DataFrame, *, block: str = "blockNumber",
           number: str = "number", date: str = "date", width: int = 10000) -> DataFrame:
    """Per day, swaps in the raw data (blocks of the day by
    their min/max number) against the summed swapCount of the day table."""
    bounds = blocks.groupBy(date).agg(F.min(number).alias("firstBlock"), F.max(number).alias("lastBlock"))
    inp = (range_join(swaps.select(block), bounds, block, "firstBlock", "lastBlock", width)
           .groupBy(date).agg(F.count("*").alias("inputSwaps")))
    out = day_stats.groupBy(date).agg(F.sum("swapCount").alias("outputSwaps"))
    return (inp.join(out, date, "full")
               .withColumn("complete", F.coalesce(F.col("inputSwaps") == F.col("outputSwaps"),
                                                  F.lit(False)).cast("string")))


def uninitialised(created: DataFrame, initialised: DataFrame, key: str) -> DataFrame:
    """Q3: created pools with no Initialize event (anti join)."""
    return created.join(initialised.select(key).distinct(), key, "left_anti")


def json_round_trip(df: DataFrame, col: str, schema) -> DataFrame:
    """Q4: decode then encode; ``same`` tells whether the same JSON comes back.
    Both are compared as parsed values, so neither blanks between tokens nor the
    order of keys count, while blanks inside a text do. Text that is no JSON is
    not the same."""
    back = F.to_json(F.from_json(F.col(col), schema))
    canonical = lambda c: F.to_json(F.try_parse_json(c))
    same = F.coalesce(canonical(back) == canonical(F.col(col)), F.lit(False))
    return df.withColumn("reencoded", back).withColumn("same", F.when(F.col(col).isNotNull(), same).cast("string"))


def tolerance_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str,
                   tol: float) -> DataFrame:
    """Keyed full join; rows missing on one side or differing by more
    than ``tol`` (absolute)."""
    lv, rv = left.select(*keys, F.col(value).alias("left")), right.select(*keys, F.col(value).alias("right"))
    j = lv.join(rv, list(keys), "full")
    bad = F.col("left").isNull() | F.col("right").isNull() | (F.abs(F.col("left") - F.col("right")) > tol)
    return j.where(bad).withColumn("diff", F.col("left") - F.col("right"))


def cross_rate(df: DataFrame, ratio: Column, tol: float = 0.001) -> DataFrame:
    """Q6: flag rows whose converted/own ratio is off 1 by more than ``tol``."""
    return df.withColumn("ratio", ratio).withColumn(
        "flagged", (F.abs(F.col("ratio") - 1) > tol).cast("string"))


def key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q7: keys that occur more than once (partially aggregated count)."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def top_by_sum(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """Top ``k`` keys by summed value (ties by key). The sum is
    partially aggregated; ``orderBy().limit()`` plans a TakeOrderedAndProject
    (each task keeps its own top k), so no full sort happens."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(value).alias("total"))
              .orderBy(F.col("total").desc(), F.col(key)).limit(k))


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values (e.g. dates of an epoch)."""
    return df.select(*cols).distinct()
