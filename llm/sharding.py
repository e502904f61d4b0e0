"""Sharding by extendible hashing.

The directory is indexed by a prefix of each document's hash bits. All
documents start in the bucket of the empty prefix; only buckets over the byte
limit are split, one bit longer at a time, until every shard fits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import store, table

#: Production limit of a shard's text bytes, and bits of one hash word.
SHARD_BYTES, BITS = 4 << 20, 60


def hash_word(key):
    """The first 60 bits of md5 as a long: the same in every SQL engine."""
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def directory(sizes: DataFrame, limit: int, step: int = 6) -> DataFrame:
    """(depth, prefix, shard_bytes, shard_docs) of every shard.

    ``sizes`` has word (60-bit hash), bytes and n (rows with that hash). Each
    round reads only the rows of oversized buckets, sums them by the next
    ``step`` bits (combined before the shuffle, so a hot bucket is a few rows
    a task) and closes the shortest prefixes that fit. A bucket still too large
    after all bits holds rows that no hash tells apart and is closed as is.
    """
    spark, depth = sizes.sparkSession, 0
    shards, over = None, None
    while True:
        top = min(BITS, depth + step)
        rows = sizes
        if over is not None:
            rows = rows.join(over, F.shiftright("word", BITS - depth) == over["prefix"], "left_semi")
        cells = rows.groupBy(F.shiftright("word", BITS - top).alias("cell")).agg(
            F.sum(F.col("bytes") * F.col("n")).alias("b"), F.sum("n").alias("n"))
        depths = F.explode(F.sequence(F.lit(depth), F.lit(top))).alias("depth")
        sums = (cells.select("cell", "b", "n", depths)
                .withColumn("prefix", F.expr(f"shiftright(cell, {top} - depth)"))
                .groupBy("depth", "prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs")))
        sums = store(sums, "directory")
        large = sums.where(F.col("shard_bytes") > limit)
        parent = large.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"))
        fits = sums.where((F.col("shard_bytes") <= limit) | (F.col("depth") == BITS))
        closed = fits.join(parent, (fits["depth"] == parent["depth"]) & (F.shiftright(fits["prefix"], 1) == parent["up"]), "left_semi")
        if depth == 0:  # the root has no parent
            closed = closed.unionByName(fits.where("depth = 0"))
        shards = closed if shards is None else shards.unionByName(closed)
        over = large.where(F.col("depth") == top).select("prefix")
        depth = top
        if depth == BITS or not over.limit(1).count():
            return shards


def shard(docs: DataFrame, key, limit: int = SHARD_BYTES) -> DataFrame:
    """doc_id, bytes, depth, shard, shard_bytes, shard_docs of every row.

    ``key`` is the string to hash; a null key is the empty one. Null text has
    0 bytes. Rows with the same key share a bucket whatever the limit: use a
    key that tells copies apart. Other columns are ignored. An empty table has
    no shards.
    """
    rows = store(docs.select("doc_id", hash_word(F.coalesce(key, F.lit(""))).alias("word"),
                             F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")), "sizes")
    sizes = rows.groupBy("word", "bytes").agg(F.count(F.lit(1)).alias("n"))
    shards = store(directory(sizes, limit), "shards")
    # the depths in use are at most 61; one equi-join a depth would read the
    # rows again, so each row gets its prefixes of those depths at once
    depths = [r[0] for r in shards.select("depth").distinct().collect()]
    options = F.array(*[F.struct(F.lit(d).alias("depth"), F.shiftright("word", BITS - d).alias("prefix")) for d in sorted(depths or [0])])
    name = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(bin(prefix), depth, '0')"))
    return (rows.withColumn("o", F.explode(options)).select("doc_id", "bytes", "o.depth", "o.prefix")
            .join(shards, ["depth", "prefix"]).select("doc_id", "bytes", "depth", name.alias("shard"), "shard_bytes", "shard_docs"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return shard(docs, F.col("doc_id").cast("string"))


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS word FROM documents),
s AS (
  SELECT depth, word >> (60 - depth) AS prefix, sum(bytes) AS b, count(*) AS n
  FROM d, range(0, 61) r(depth) GROUP BY ALL),
f AS (
  SELECT d.*, min(s.depth) AS depth FROM d JOIN s
    ON s.prefix = d.word >> (60 - s.depth) AND (s.b <= {SHARD_BYTES} OR s.depth = 60)
  GROUP BY d.doc_id, d.bytes, d.word)
SELECT f.doc_id, CAST(f.bytes AS BIGINT) AS bytes, CAST(f.depth AS INTEGER) AS depth,
  CASE WHEN f.depth = 0 THEN '' ELSE right(lpad(CAST(bin(f.word >> (60 - f.depth)) AS VARCHAR), 60, '0'), CAST(f.depth AS INTEGER)) END AS shard,
  CAST(s.b AS BIGINT) AS shard_bytes, s.n AS shard_docs
FROM f JOIN s ON s.depth = f.depth AND s.prefix = f.word >> (60 - f.depth)
"""
