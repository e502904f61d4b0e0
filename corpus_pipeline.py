"""The corpus pipeline: each stage works on what the one before it kept.

quality  drops documents that the classifier scores below its threshold
lines    takes out lines that an earlier line repeats; a document left without
         any text by this goes
near     keeps one document of each group of near duplicates (5-word shingles)
leaks    drops documents that hold a window of a benchmark item
packing  cuts the rest into token pieces and packs them into sequences
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import free, small, store, table
from llm.decontaminate import decontaminate
from llm.line_dedup import dedup_lines
from llm.near_duplicates import near_duplicates
from llm.packing import pack
from llm.quality import THRESHOLD, score, train

#: Words of a shingle in the near-duplicate stage.
SHINGLE = 5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with score >= THRESHOLD; null text is scored as empty text.
    Columns beside doc_id and text pass through, whatever their names."""
    model = train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    own = free(docs, "own_score")
    found = score(docs.withColumnRenamed("score", own), model).where(F.col("score") >= THRESHOLD).drop("score")
    return found.withColumnRenamed(own, "score").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines. One that had text and lost all of it
    goes; null, empty and short texts stay."""
    return dedup_lines(docs).where((F.col("n_repeated") == 0) | F.regexp_like("text", F.lit(r"\S"))).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group, and documents without
    words. Rows that repeat id and text are one document; rows without an id
    stay where no row of their group has one."""
    near_id, near_text = free(docs, "near_id"), free(docs, "near_text")
    found = store(near_duplicates(docs, SHINGLE).select(F.col("doc_id").alias(near_id), F.col("text_hash").alias(near_text), "kept", "n_shingles"), "found")
    each = found.groupBy(near_id, near_text).agg(F.min("kept").alias("kept"), F.min("n_shingles").alias("n"), F.count(F.lit(1)).alias("times"))
    same = F.col("doc_id").eqNullSafe(F.col(near_id)) & F.xxhash64("text").eqNullSafe(F.col(near_text))
    again = each.where("kept AND times > 1 AND n > 0").where(F.col(near_id).isNotNull()).select(near_id, near_text)
    left = docs.join(small(each.where("NOT kept").select(near_id, near_text).unionByName(again)), same, "left_anti")
    if again.limit(1).count():
        left = left.unionByName(docs.join(small(again), same, "left_semi").dropDuplicates(["doc_id", "text"]))
    return left


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.where(F.col("n_hit") == 0).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a token piece of every document."""
    return pack(docs).drop("ids")


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near", near_stage), ("leaks", leak_stage), ("packing", packing_stage)]

#: A trained model decides the first stage, so SQL cannot express the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
