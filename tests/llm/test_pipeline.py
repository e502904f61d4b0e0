"""The corpus pipeline: each stage on planted cases, and the whole."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm import common
from tests.llm.helpers import DOCUMENTS, SMALL, awkward, near_groups, rows_of, save

WORDS = [f"{a}{b}" for a in ("rain", "stone", "river", "cloud", "walk", "seven", "bright") for b in ("s", "ing", "er", "ed", "", "ly", "ful")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(8)
    item = prose(rng, 25)
    passage = prose(rng, 60)
    rows = [(i, prose(rng, rng.randrange(30, 90))) for i in range(300)]
    junk = [(i, prose(rng, 60).upper().replace(" ", "$$$ ")) for i in range(300, 400)]
    leak = [(500 + k, prose(rng, 30) + "\n" + prose(rng, 5) + " " + item.upper() + " " + prose(rng, 20)) for k in range(3)]
    copy = [(600, rows[0][1]), (601, rows[1][1] + " once more")]
    shared = [(700 + k, prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40)) for k in range(3)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows + junk + leak + copy + shared], DOCUMENTS)
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    return save(spark, tmp_path_factory.mktemp("planted"), documents=docs, labels=labels, benchmark=bench), passage


def test_stages_on_planted_cases(spark, planted):
    folder, passage = planted
    docs, left, found = spark.read.parquet(f"{folder}/documents.parquet"), {}, {}
    for name, stage in corpus_pipeline.STAGES:
        before = rows_of(docs)
        docs = stage(spark, docs, folder)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        after = rows_of(docs)
        ids = {r["doc_id"] for r in after}
        left[name] = {r["doc_id"] for r in before} - ids
        found[name] = (before, after)
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert left["quality"] == set(range(300, 400))
    assert left["lines"] == {600}  # all of its text is there already
    assert [r["doc_id"] for r in found["lines"][1] if passage in r["text"]] == [700]
    before = [(r["doc_id"], r["text"]) for r in found["near"][0]]
    groups, _ = near_groups(before, 5)
    assert left["near"] == {i for i, g in groups.items() if i != g} and 601 in left["near"]
    assert left["leaks"] == {500, 501, 502}
    assert left["packing"] == set()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_awkward_rows(spark, planted, name, stage):
    docs = awkward(spark)
    got = rows_of(stage(spark, docs, planted[0]))
    if name == "near":  # the repeated row and the copy without an id go
        assert len(got) == docs.count() - 3 and sum(r["text"] == "one two three four five six" for r in got) == 1
    if name == "leaks":
        assert len(got) == docs.count()
    assert stage(spark, docs.limit(0), planted[0]).count() == 0


CLASHING = ["links", "near", "gone", "doc", "its_id", "found", "hash", "text_hash", "_id", "near_id", "near_text", "_score", "own_score", "score", "spans", "items",
            "n_words", "n_hit", "quality", "label", "node", "component", "component_id", "key", "kept", "n", "times", "word", "id", "place", "pos", "line", "ids",
            "bucket", "rank", "length", "start", "n_lines", "n_repeated", "Gone", "first", "text_2"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_with_clashing_columns(spark, planted, name, stage):
    folder, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    extra = [c for c in CLASHING if c != "Gone"]
    wide = docs.select("*", *[F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(5).cast("long").alias("end"))).alias(c) if c == "spans" else F.lit("mine").alias(c) for c in extra])
    if name != "packing":
        got = stage(spark, wide, folder)
        assert got.columns == wide.columns
        assert sorted(map(tuple, got.select("doc_id", "text").collect())) == sorted(map(tuple, stage(spark, docs, folder).collect()))
        assert {r["links"] for r in got.select("links").collect()} == {"mine"}
    else:
        assert stage(spark, wide, folder).count() == stage(spark, docs, folder).count()
    if name == "lines":
        named = stage(spark, docs.withColumn("Gone", F.lit("mine")), folder)
        assert named.columns == ["doc_id", "text", "Gone"] and {r["Gone"] for r in named.collect()} == {"mine"}


def test_pipeline_runs(spark):
    got = rows_of(corpus_pipeline.run(spark, SMALL))
    assert got and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(got[0])


def test_workers_are_sent_few_bytes_at_a_time(spark, planted):
    folder, docs = planted[0], spark.read.parquet(f"{planted[0]}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        spark.conf.unset(common.BATCH_SETTING)
        stage(spark, docs, folder)
        assert name == "lines" or spark.conf.get(common.BATCH_SETTING) == str(common.BATCH), name
    long = spark.range(4000, numPartitions=1).select(F.repeat(F.lit("x"), 4000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])
    got = [r["n"] for r in common.by_bytes(long).mapInArrow(sizes, "n long").collect()]
    assert sum(got) >= 16_000_000 and max(got) <= common.BATCH + 10_000


def test_the_caller_s_own_batches_stand(spark):
    spark.conf.set(common.BATCH_SETTING, "77777")
    try:
        common.by_bytes(spark.range(1))
        assert spark.conf.get(common.BATCH_SETTING) == "77777"
    finally:
        spark.conf.unset(common.BATCH_SETTING)
