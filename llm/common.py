"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % F.lit(mod)


def held_out(doc_id: Column, mod: int) -> Column:
    """Rows no model may learn from: remainder 0, and rows without an id."""
    return F.coalesce(remainder(doc_id, mod) == 0, F.lit(True))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def free(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Rows of a side that a join may broadcast; a larger side is shuffled.
SMALL = 500_000


def small(df: DataFrame) -> DataFrame:
    """``df``, sent to every task if its rows are few; else joins shuffle."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


#: Bytes of rows that Spark hands to a Python worker at a time.
BATCH, BATCH_SETTING = 2_000_000, "spark.sql.execution.arrow.maxBytesPerBatch"


def by_bytes(df: DataFrame) -> DataFrame:
    """``df``, whose session cuts the batches for Python workers by bytes too:
    10,000 rows of long texts at a time are many copies in the executor and its
    workers. A setting of the caller's own stands."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, str(BATCH))
    return df


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder in the shared checkpoint directory."""
    return f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared checkpoint directory and
    read it back: cuts the lineage, and a lost executor costs no rework."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of at most ``limit`` in sum, or of one larger one."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def distinct(data: bytes, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct pieces of ``data``, cut before each place of ``at`` (the
    first is 0), and which of them stands at each place."""
    offsets = np.append(at, len(data)).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    return found.dictionary, found.indices.to_numpy()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over the undirected links.

    ``nodes`` has a long ``id``, ``edges`` has ``a`` and ``b``. Ids without a
    link are their own component. Each round lowers every label to the
    smallest label among its neighbours and then to its label's label, so
    chains shorten by half; each round's table is written to shared storage,
    and the driver only learns how many labels moved.
    """
    both = store(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b"), "edges")
    linked = store(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                   .select("id", F.least("id", "m").alias("component")), "labels")
    moved = linked.limit(1).count()
    while moved:
        label = small(linked)
        near = (both.join(label.toDF("b", "near"), "b").groupBy(F.col("a").alias("id")).agg(F.min("near").alias("near"))
                .join(label, "id").select("id", F.col("component").alias("was"), F.least("component", "near").alias("now")))
        new = store(near.join(label.toDF("now", "next"), "now", "left")
                    .select("id", "was", F.least("now", F.coalesce("next", "now")).alias("component")), "labels")
        moved = new.where("was <> component").limit(1).count()
        linked = new.select("id", "component")
    return (nodes.select("id").join(linked, "id", "left")
            .select("id", F.coalesce("component", "id").alias("component")))
