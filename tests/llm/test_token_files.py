"""Token files: ids against the tokenizer, encodings, and selective reads."""

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm import token_files as tf
from tests.llm.helpers import SMALL, awkward, empty, rows_of

SIGNS = ["a", "B", " ", "  ", "\n", "\t", "\r", "é", "日", "'s", "'ll", "12", ".", "!?", "\u3000", "\xa0", "\x1c", "\x85", "\0", "<|endoftext|>",
         "İ", "z,", " é.", ",'s", "\u200b", "word", "\x0b", "\u0301", "<|", "|>"]


@pytest.fixture(scope="module")
def plain():
    found = Tokenizer.from_file(public_tokenizers.path(tf.VOCABULARY))
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def test_chunk_tokenizer_is_the_tokenizer(plain, monkeypatch):
    monkeypatch.setattr(tf, "MEMORY", 300)
    rng, mine = random.Random(1), tf.ChunkTokenizer(tf.VOCABULARY)
    texts = ["".join(rng.choices(SIGNS, k=rng.randrange(14))) for _ in range(6000)]
    for i in range(0, len(texts), 200):
        part = texts[i:i + 200]
        ids, stops = mine([t.encode() for t in part])
        for text, found in zip(part, np.split(ids, stops[:-1]), strict=True):
            assert found.tolist() == plain(text), repr(text)


def stream(rows, plain, end=2):
    """Expected doc_id, start, ids in id order (ids are distinct)."""
    at = 0
    for doc, text in sorted(rows):
        ids = plain(text) + ([] if end is None else [end])
        yield doc, at, ids
        at += len(ids)


def test_query_reads_back_what_the_tokenizer_gives(spark, plain):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows_of(tf.op13_token_files(spark, SMALL)))
    assert got == [(d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, at, ids in stream(docs, plain)]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_files_have_the_encoding_groups_and_indexes_asked_for(spark, plain, tmp_path, encoding):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choices(SIGNS, k=60))) for k in range(3000)]
    path = str(tmp_path / "t")
    tf.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path, encoding=encoding, row_group=64 << 10, page=4 << 10)
    groups = 0
    for f in glob.glob(f"{path}/tokens/*.parquet"):
        held = pq.ParquetFile(f).metadata
        groups += held.num_row_groups
        for g in range(held.num_row_groups):
            for c in range(held.num_columns):
                column = held.row_group(g).column(c)
                name, used = column.path_in_schema, set(column.encodings)
                assert column.has_offset_index and (column.has_column_index or name.startswith("ids"))
                if name.startswith("ids"):
                    assert ("RLE_DICTIONARY" in used or "PLAIN_DICTIONARY" in used) == (encoding == "dictionary")
                    assert ("DELTA_BINARY_PACKED" in used) == (encoding == "delta")
                else:
                    assert "DELTA_BINARY_PACKED" in used
    assert groups > len(glob.glob(f"{path}/tokens/*.parquet"))
    want = list(stream(rows, plain))
    got = sorted(tuple(r) for r in tf.read_tokens(spark, path).select("doc_id", "start", "ids").collect())
    assert got == want
    whole = [x for _, _, ids in want for x in ids]
    for first, count in ((0, 1), (5, 400), (len(whole) // 2, 3000), (len(whole) - 7, 50), (len(whole) + 5, 3), (0, len(whole))):
        found = sorted((r["start"], list(r["ids"])) for r in tf.read_window(spark, path, first, count).collect())
        assert [x for _, ids in found for x in ids] == whole[first:first + count]
        assert all(whole[s:s + len(ids)] == ids for s, ids in found)


def test_metadata_is_read_without_tokens(spark, tmp_path):
    path = str(tmp_path / "t")
    tf.write_tokens(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), path)
    found = tf.read_tokens(spark, path, "doc_id", "n_tokens").where(F.col("doc_id") > 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan and "GreaterThan(doc_id,1)" in plan
    assert [tuple(r) for r in found.collect()] == [(2, 1)]
    with pytest.raises(ValueError):
        tf.write_tokens(found, path, encoding="plain")


def test_awkward_and_empty_tables(spark, plain, tmp_path):
    docs, path = awkward(spark).withColumn("start", F.lit("mine")).withColumn("h", F.lit(1)), str(tmp_path / "t")
    tf.write_tokens(docs, path, end=None)
    got = sorted(tf.read_tokens(spark, path).collect(), key=lambda r: (r["start"], r["n_tokens"]))
    want = [(r["doc_id"], plain(r["text"])) for r in docs.collect()]
    assert sorted((r["doc_id"] or -1, list(r["ids"])) for r in got) == sorted((d or -1, ids) for d, ids in want)
    assert [r["doc_id"] or -1 for r in got if r["n_tokens"]] == sorted(d or -1 for d, ids in want if ids)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    tf.write_tokens(empty(spark), str(tmp_path / "e"))
    assert rows_of(tf.checksums(tf.read_tokens(spark, str(tmp_path / "e")))) == [] and rows_of(tf.read_window(spark, str(tmp_path / "e"), 0, 5)) == []
