"""Sinks and catalog statements: S10, S14-S16, S19-S25.

Writes go to paths a cluster shares; scratch data of a job (upsert staging)
lives under ``spark.checkpoint.dir`` (see ``session.checkpoint_dir``), never
in a machine-local folder.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType
from pyspark.sql.window import Window

from tidepool.session import checkpoint_dir


# -- S10/S11/S12: ordered publish and stream read ------------------------------

def ordered_publish(df: DataFrame, path: str | None = None, *, key: str = "address",
                    order: str = "logId", partitions: int | None = None,
                    kafka: dict | None = None) -> DataFrame | None:
    """(key, JSON value) rows in ``order`` order.

    With ``kafka`` options (``kafka.bootstrap.servers``, ``topic``) this is
    the Kafka sink; otherwise the rows are range-partitioned on the order key
    and sorted inside each partition (a distributed global sort: file i holds
    keys below file i+1) and written as Parquet files a stream can replay.
    """
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    out = df.select(F.col(key).cast("string").alias("key"), value.alias("value"),
                    F.col(order).alias("__order"))
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    out = out.repartitionByRange(n, "__order").sortWithinPartitions("__order")
    if kafka:
        (out.drop("__order").write.format("kafka").options(**kafka).save())
        return None
    if path is None:
        return out
    out.withColumnRenamed("__order", "order").write.mode("overwrite").parquet(path)
    return None


def publish_in_order(df: DataFrame, path: str, *, order: str = "logId", batches: int = 4,
                     key: str = "address", as_json: bool = True, files: int = 8) -> int:
    """Replayable ordered buffer without a broker: ``batches`` appends, each of
    the next range of the order key in the same number of files, written in
    parallel. Returns that number: a file stream with as many
    ``maxFilesPerTrigger`` replays the rows range by range, since a file source
    takes files by modification time; inside a range their order is free.

    Rows are dealt to ``files`` by a hash of the order key. A file source cannot
    tell where a range ends, so the number of files must be the same in every
    range: it is halved while some range would leave one of them empty, which
    only tiny ranges do. At scale the transport is the Kafka path of
    ``ordered_publish`` / ``read_published``.

    The input is computed once: it is written as a table under the shared
    checkpoint folder (cutting its lineage) and the ranges are read back from
    it with pushed-down filters. The table goes when the ranges are written, and
    a range's shuffle files before the next range.
    """
    spark, stage = df.sparkSession, scratch_path(df.sparkSession, "publish-stage")
    try:
        with shuffles_freed(spark):
            return _publish_ranges(staged_at(df, stage), path, df.columns, order, batches, key, as_json, files)
    finally:
        discard(spark, stage)


def _publish_ranges(rows: DataFrame, path: str, columns, order: str, batches: int, key: str, as_json: bool, files: int) -> int:
    lo, hi = rows.agg(F.min(order), F.max(order)).first()
    if lo is None:
        return 1
    step = (hi - lo) // batches + 1
    part = F.floor((F.col(order) - F.lit(lo)) / F.lit(step))
    bucket = lambda n: F.pmod(F.xxhash64(order), F.lit(n))
    halves = [files >> k for k in range(files.bit_length())]
    dealt = rows.groupBy(part).agg(*[F.count_distinct(bucket(n)).alias(f"f{n}") for n in halves]).collect()
    files = next(n for n in halves if all(r[f"f{n}"] == n for r in dealt))
    # one number for every partition that repartition() would deal it to
    partition = F.pmod(F.hash("id"), F.lit(files))
    found = rows.sparkSession.range(64 * files).groupBy(partition.alias("p")).agg(F.min("id").alias("id")).orderBy("p").collect()
    numbers = F.array(*[F.lit(r["id"]).cast("long") for r in found])
    for i in range(batches):
        now = rows.where((F.col(order) >= lo + i * step) & (F.col(order) < lo + (i + 1) * step))
        now = now.repartition(files, F.get(numbers, bucket(files).cast("int"))).sortWithinPartitions(order)
        if as_json:
            now = now.select(F.col(key).cast("string").alias("key"),
                             F.to_json(F.struct(*[F.col(c) for c in columns])).alias("value"),
                             F.col(order).cast("long").alias("order"))
        now.write.mode("append").option("compression", SCRATCH_COMPRESSION).parquet(path)
    return files


def read_published(spark: SparkSession, path: str, schema, *, stream: bool = False,
                   max_files_per_trigger: int | None = None,
                   kafka: dict | None = None) -> DataFrame:
    """S11 + S12: read the published rows (batch or stream) and decode the
    JSON value with the producer's schema."""
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    if kafka:
        reader = spark.readStream if stream else spark.read
        raw = (reader.format("kafka").options(**kafka).option("startingOffsets", "earliest").load()
                     .select(F.col("value").cast("string").alias("value")))
    else:
        file_schema = StructType([StructField("key", StringType()), StructField("value", StringType()),
                                  StructField("order", LongType())])
        if stream:
            r = spark.readStream.schema(file_schema)
            if max_files_per_trigger:
                r = r.option("maxFilesPerTrigger", max_files_per_trigger)
            raw = r.parquet(path)
        else:
            raw = spark.read.schema(file_schema).parquet(path)
    dec = raw.select(F.from_json(F.col("value"), schema).alias("r"))
    return dec.select(*[F.col("r").getField(f.name).alias(f.name) for f in schema.fields])


# -- S14: partition overwrite --------------------------------------------------

def overwrite_partitions(df: DataFrame, path: str, partition_col: str = "date",
                         fmt: str = "parquet") -> None:
    """Replace exactly the partitions present in ``df`` (dynamic mode);
    other partitions of the table stay as they are."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).format(fmt).save(path))


def write_partitioned(df: DataFrame, path: str, partition_col: str, compression: str = "snappy") -> None:
    """A dataset under ``<col>=<value>`` folders, Snappy compressed."""
    df.write.mode("overwrite").option("compression", compression).partitionBy(partition_col).parquet(path)


# -- S15: upsert by partition rewrite ------------------------------------------

def upsert(batch: DataFrame, path: str, *, keys=("date", "logId"), partition_col: str = "date",
           batch_id: int | str | None = None, newest: str | None = None) -> None:
    """Merge ``batch`` into the Parquet table at ``path`` on ``keys``:
    matched rows are replaced, new rows inserted (update all / insert all).

    No row-level table format is installed. When no key of the batch is in
    the table yet (checked with a semi join on the touched partitions only),
    the batch is appended as new files. Otherwise only the partitions the
    batch touches are rewritten: read them, drop the rows the batch replaces
    (left anti join on the keys), add the batch, stage under the checkpoint
    dir, then overwrite those partitions dynamically. Of a key that a batch
    holds twice, the row with the largest ``newest`` stays; rows that repeat
    are one row; different rows of a key without ``newest`` are refused, as
    any choice would lose one. Columns that only the table has keep their
    values on untouched rows and are null on new ones. Replaying the same ``batch_id`` gives the same
    table, so a retried micro-batch is idempotent. What was staged goes at the end.
    """
    spark = batch.sparkSession
    keys = list(keys)
    if newest:
        w = Window.partitionBy(*keys).orderBy(F.col(newest).desc())
        batch = batch.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    else:
        batch = batch.distinct() if not any(isinstance(f.dataType, MapType) for f in batch.schema.fields) else batch
    # a fresh staging folder per call: a replayed batch id rebuilds the same
    # result from the target and the batch, never from an earlier attempt
    tag = f"{batch_id}-" if batch_id is not None else ""
    stage = f"{checkpoint_dir(spark)}/upsert-stage/{tag}{uuid.uuid4().hex}"
    out = f"{stage}-merged"
    try:
        batch.write.mode("overwrite").option("compression", SCRATCH_COMPRESSION).parquet(stage)
        _merge(spark.read.parquet(stage), path, keys, partition_col, newest, out)
    finally:
        discard(spark, stage)
        discard(spark, out)


def _merge(staged: DataFrame, path: str, keys: list[str], partition_col: str, newest: str | None, out: str) -> None:
    """``upsert`` of a staged batch; ``out`` is where merged partitions are staged."""
    spark = staged.sparkSession
    if not newest and staged.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError(f"several rows of one key {keys} and no column to order them by")
    try:
        existing = spark.read.option("mergeSchema", "true").parquet(path)
        existing = existing.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in staged.schema.fields
                                         if f.name in existing.columns and existing.schema[f.name].dataType != f.dataType})
        has_target = True
    except Exception as e:  # noqa: BLE001 - first batch: the table does not exist yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e) and "UNABLE_TO_INFER" not in str(e):
            raise
        has_target = False
    if not has_target:
        overwrite_partitions(staged, path, partition_col)
        return
    touched = staged.select(partition_col).distinct()
    # semi join keeps only the touched partitions (pruned at runtime by AQE /
    # dynamic partition pruning when the table is partitioned on the column)
    in_touched = existing.join(touched, partition_col, "left_semi")
    # insert-only batch (the usual case of an ordered stream): add files to
    # the partitions instead of rewriting them
    collides = in_touched.select(*keys).join(staged.select(*keys), keys, "left_semi").limit(1).count() > 0
    if not collides:
        staged.write.mode("append").partitionBy(partition_col).parquet(path)
        return
    kept = in_touched.join(staged.select(*keys), keys, "left_anti")
    merged = kept.unionByName(staged, allowMissingColumns=True)
    merged.write.mode("overwrite").partitionBy(partition_col).parquet(out)
    overwrite_partitions(spark.read.parquet(out), path, partition_col)


# -- S20-S25: catalog ----------------------------------------------------------

def create_database(spark: SparkSession, name: str) -> None:
    """S20."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_external_table(spark: SparkSession, table: str, location: str, *, ddl: str | None = None,
                          partitioned_by: str | None = None, fmt: str = "parquet") -> None:
    """External table over a location; ``ddl`` gives the columns."""
    cols = f" ({ddl})" if ddl else ""
    part = f" PARTITIONED BY ({partitioned_by})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table}{cols} USING {fmt}{part} LOCATION '{location}'")


def repair_table(spark: SparkSession, table: str) -> None:
    """Register partition folders written by jobs."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def partitions(spark: SparkSession, table: str) -> DataFrame:
    """Partition values of a table, ``date=...`` text split to the value."""
    return spark.sql(f"SHOW PARTITIONS {table}").select(
        F.element_at(F.split(F.col("partition"), "="), -1).alias("value"))


def update_partitions(spark: SparkSession, table: str, today: str, days_ahead: int = 3,
                      column: str = "date") -> list[str]:
    """Register day partitions from the day after the latest known one
    (or ``today`` when there is none) to ``today + days_ahead``.

    The day list is built by Spark (``sequence`` of dates); the statements
    are a handful of DDL calls, one per new day.
    """
    latest = partitions(spark, table).agg(F.max("value").alias("m"))
    days = latest.select(F.explode(F.sequence(
        F.coalesce(F.date_add(F.to_date("m"), 1), F.to_date(F.lit(today))),
        F.date_add(F.to_date(F.lit(today)), days_ahead))).alias("d"))
    new_days = [r["d"].isoformat() for r in days.collect()]
    for d in new_days:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({column}='{d}')")
    return new_days


# Names, types and order of the published table's columns.
DAY_SWAPS_DDL = """
address STRING, pool STRING, pair STRING, swapCount BIGINT,
firstPrice0 DOUBLE, firstPrice1 DOUBLE, lastPrice0 DOUBLE, lastPrice1 DOUBLE,
firstPriceLogId DECIMAL(38,18), lastPriceLogId DECIMAL(38,18),
minPrice0 DOUBLE, minPrice1 DOUBLE, maxPrice0 DOUBLE, maxPrice1 DOUBLE,
liquidityWeightedPrice0 DOUBLE, liquidityWeightedPrice1 DOUBLE,
ttAbsPriceDeltaPct0 DOUBLE, ttAbsPriceDeltaPct1 DOUBLE, skewness0 DOUBLE, skewness1 DOUBLE,
kurtosis0 DOUBLE, kurtosis1 DOUBLE, trend0 DOUBLE, trend1 DOUBLE,
volume0 DOUBLE, volume1 DOUBLE, netAmount0 DOUBLE, netAmount1 DOUBLE,
volumeBase DOUBLE, volumeUsd DOUBLE, avgVolumeBase DOUBLE, avgVolumeUsd DOUBLE,
medVolumeBase DOUBLE, medVolumeUsd DOUBLE, avgTicks DOUBLE, medTicks DOUBLE,
avgTickDepth0 DOUBLE, avgTickDepth1 DOUBLE, avgGas DOUBLE, medGas DOUBLE,
tipQ1 DOUBLE, tipQ2 DOUBLE, tipQ3 DOUBLE, avgTotalFeePct DOUBLE, medTotalFeePct DOUBLE,
avgTotalFeesUsd DOUBLE, medTotalFeesUsd DOUBLE,
price0Series ARRAY<STRUCT<logId:DECIMAL(38,18),time:TIMESTAMP,price:DOUBLE,priceDeltaPct:DOUBLE,netAmount:DOUBLE,volume:DOUBLE>>,
price1Series ARRAY<STRUCT<logId:DECIMAL(38,18),time:TIMESTAMP,price:DOUBLE,priceDeltaPct:DOUBLE,netAmount:DOUBLE,volume:DOUBLE>>,
costSeries ARRAY<STRUCT<logId:DECIMAL(38,18),time:TIMESTAMP,volumeUsd:DOUBLE,gas:BIGINT,gasXTipUsd:DOUBLE,gasXBaseFeeUsd:DOUBLE,LPFeeUsd:DOUBLE,tipGwei:DOUBLE,baseFeeGwei:DOUBLE,totalFeePct:DOUBLE>>,
token0 STRUCT<symbol:STRING,decimals:DECIMAL(38,0),address:STRING>,
token1 STRUCT<symbol:STRING,decimals:DECIMAL(38,0),address:STRING>,
fee BIGINT, isBasePool BOOLEAN,
priceDelta0 DOUBLE, priceDelta1 DOUBLE, priceDeltaPct0 DOUBLE, priceDeltaPct1 DOUBLE,
priceRange0 DOUBLE, priceRange1 DOUBLE, volatility0 DOUBLE, volatility1 DOUBLE, volatility DOUBLE,
priceImpactPctFor1kUsd DOUBLE, date STRING
"""


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for one job's data."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Of data that is written to be read a few times: half the size of the default.
SCRATCH_COMPRESSION = "zstd"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to scratch and read back: computed once however often it
    is read, and columns that a reader does not need are not read."""
    return staged_at(df, scratch_path(df.sparkSession, name))


def staged_at(df: DataFrame, path: str) -> DataFrame:
    """``staged`` in a folder that the caller names, and discards."""
    df.write.option("compression", SCRATCH_COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this job, in whatever store it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Inside, a query's shuffle files are deleted when the query ends, not when
    the driver happens to collect its garbage. For queries whose results are
    written and read back: one that is run again computes its shuffles again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
