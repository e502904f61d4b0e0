"""Token-id output as Parquet list columns, and selective reads of it.

One row a document, in ascending id order over all files: its token ids as a
list column, and narrow metadata columns. Token ids are dictionary encoded (a
vocabulary is a small set) or, like the metadata, delta encoded; row groups and
pages have set sizes and every file carries page indexes, so a reader of some
documents, of a window of the token stream or of the metadata alone reads only
those pages. A file knows its own part of the order; a small manifest has, for
every part, the tokens before it.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import new_folder, slices, table

VOCABULARY, END = "byte_bpe_50k.json", 2
#: Bytes of a row group and of a page.
ROW_GROUP, PAGE = 32 << 20, 64 << 10
#: Text bytes a worker tokenises at a time (one long text more), and chunks it
#: remembers the ids of before it forgets half of them.
SLICE, MEMORY = 2_000_000, 1_000_000

#: What the cutting below cannot tell apart: longer runs of white space, and
#: white space beyond ASCII (as UTF-8). Fixed values of the white space property.
LONG_RUN = re.compile(rb"\s{3}|\s\s\Z")
WIDE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


class Places(dict):
    """Index of each chunk; a new one gets the next and is noted as unknown."""

    def __init__(self) -> None:
        self.unknown: list[bytes] = []
        self.next = 0

    def __missing__(self, chunk: bytes) -> int:
        self[chunk] = k = self.next
        self.next += 1
        self.unknown.append(chunk)
        return k


class ChunkTokenizer:
    """Byte-level token ids of texts, remembering the ids of chunks.

    The vocabulary's own splitting never lets a token reach from a sign into
    the white space behind it, so a text is cut before each blank and newline
    and its ids are those of its chunks. New chunks that start with one blank
    (or newline) go through the tokenizer many at a time: exactly their first
    tokens start with it, which tells them apart again. Texts that the cut is
    not sure of go through the tokenizer whole.
    """

    def __init__(self, name: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(public_tokenizers.path(name))
        self.special = [t.content.encode() for t in self.encoder.get_added_tokens_decoder().values()]
        vocab = self.encoder.get_vocab()
        self.heads = {}
        for byte, sign in ((b" ", "Ġ"), (b"\n", "Ċ")):  # the vocabulary's letters for these two bytes
            heads = np.zeros(max(vocab.values()) + 1, bool)
            heads[[i for t, i in vocab.items() if t.startswith(sign)]] = True
            self.heads[byte] = heads
        self.clear()

    def clear(self) -> None:
        self.place = Places()
        self.first, self.size, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0
        self.ids = np.zeros(1 << 20, np.int32)

    def forget(self) -> None:
        """Keep the half that was met first: frequent chunks are met early."""
        old = list(self.place.items())[:len(self.place) // 2]
        k = np.array([i for _, i in old], np.int64)
        size = self.size[k]
        ids = self.gather(self.first[k], size)
        self.clear()
        kept = [self.place[c] for c, _ in old]
        self.place.unknown.clear()
        self.put(kept, ids, np.cumsum(size))

    def gather(self, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        return self.ids[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())]

    def put(self, places: list[int], ids: np.ndarray, stops: np.ndarray) -> None:
        """Remember the ids of entries, which stand one after the other."""
        while self.place.next > len(self.first):
            self.first, self.size = np.resize(self.first, 2 * len(self.first)), np.resize(self.size, 2 * len(self.size))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        starts = np.append(0, stops[:-1])
        self.ids[self.used:self.used + len(ids)] = ids
        self.first[places], self.size[places] = self.used + starts, stops - starts
        self.used += len(ids)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.encoder.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(x.ids, np.int32) for x in found]

    def learn(self) -> None:
        """Find the ids of the chunks that are unknown so far."""
        place = self.place
        unknown, place.unknown = place.unknown, []
        together: dict[bytes, list[bytes]] = {b" ": [], b"\n": []}
        odd = []
        for c in unknown:
            sure = c[:1] in together and len(c) > 1 and not c[1:2].isspace() and not c[-1:].isspace() and len(c.split()) == 1
            (together[c[:1]] if sure else odd).append(c)
        for byte, found in together.items():
            for i in range(0, len(found), 4000):
                part = found[i:i + 4000]
                ids = self.encode([b"".join(part)])[0]
                starts = np.flatnonzero(self.heads[byte][ids])
                if len(starts) == len(part):
                    self.put([place[c] for c in part], ids, np.append(starts[1:], len(ids)))
                else:
                    odd += part
        for c, ids in zip(odd, self.encode(odd), strict=True):
            self.put([place[c]], ids, np.array([len(ids)]))

    def plain(self, text: bytes) -> bool:
        """Whether cutting before each blank and newline is sure."""
        if not text or text[:1].isspace() or b"\0" in text or any(s in text for s in self.special):
            return False
        spaced = text.replace(b"\n", b" ")
        if b"   " in spaced or spaced.endswith(b"  "):
            return False
        if any(s in text for s in (b"\t", b"\r", b"\x0b", b"\x0c")) and LONG_RUN.search(text):
            return False
        return text.isascii() or not any(s in text for s in (b"\xc2", b"\xe1", b"\xe2", b"\xe3")) or not WIDE.search(text)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts one after the other, and where each text's end."""
        if len(self.place) > MEMORY or self.used > 16 * MEMORY:
            self.forget()
        get, found = self.place.__getitem__, []
        for t in texts:
            if self.plain(t):
                # a newline in front makes the first word a chunk like the others
                chunks = (b"\n" + t).replace(b" ", b"\0 ").replace(b"\n", b"\0\n").split(b"\0")[1:]
                found.append(np.fromiter(map(get, chunks), np.int64, len(chunks)))
            else:  # an entry of its own that nothing finds again
                ids = np.append(np.int32(0), self.encode([t])[0])
                found.append(np.array([self.place.next]))
                self.place.next += 1
                self.put(found[-1], ids, np.array([len(ids)]))
        if not found:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.learn()
        stops = np.cumsum([len(k) for k in found])
        k = np.concatenate(found)
        first, size = self.first[k], self.size[k]
        heads = np.append(0, stops[:-1])
        first[heads], size[heads] = first[heads] + 1, size[heads] - 1  # without the first newline
        return self.gather(first, size), np.cumsum(size)[stops - 1]


_READY: dict[str, ChunkTokenizer] = {}


def _tokenizer(name: str) -> ChunkTokenizer:
    """One tokenizer a worker process, with what it remembers."""
    if name not in _READY:
        _READY[name] = ChunkTokenizer(name)
    return _READY[name]


COLUMNS = "doc_id long, part int, start long, n_tokens int, ids array<int>"


def token_rows(docs: DataFrame, vocabulary: str, end: int | None) -> DataFrame:
    """doc_id, part (the writing task), start in that part, n_tokens, ids, in
    the order of the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, at = _tokenizer(vocabulary), TaskContext.get().partitionId(), 0
        for b in batches:
            texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            for i, j in slices([len(t) for t in texts], SLICE):
                ids, stops = encode(texts[i:j])
                if end is not None:
                    ids, stops = np.insert(ids, stops, end), stops + np.arange(1, j - i + 1)
                stops = np.append(0, stops)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(np.full(j - i, part, np.int32)), pa.array(at + stops[:-1]),
                                                  pa.array(np.diff(stops).astype(np.int32)), pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(ids))],
                                                 names=["doc_id", "part", "start", "n_tokens", "ids"])
                at += int(stops[-1])
    return docs.mapInArrow(run, COLUMNS)


def write_tokens(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end: int | None = END, encoding: str = "dictionary",
                 row_group: int = ROW_GROUP, page: int = PAGE) -> None:
    """Tokenise ``docs`` (doc_id, text) into ``path``/tokens and ``path``/manifest.

    ``encoding`` of the ids is "dictionary" or "delta"; metadata is always
    delta encoded. Documents go by doc_id, null first, then by the text's hash:
    rows that repeat an id are all written, and a hot id is cut over files.
    Null text is the empty text, which has only ``end`` (nothing if that is
    None). Other columns are ignored. An empty table gives empty tables.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")
    # where id and text repeat, the place in the input tells rows apart
    keyed = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("row")]
    rows = token_rows(keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"), vocabulary, end)
    plain = {f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "part", "start", "n_tokens")}
    (rows.write.options(**plain, **{"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "true", "parquet.block.size": row_group,
                                    "parquet.enable.dictionary#ids.list.element": str(encoding == "dictionary").lower(),
                                    "parquet.page.size": page, "parquet.dictionary.page.size": 1 << 20, "compression": "zstd"})
     .parquet(f"{path}/tokens"))
    spark = docs.sparkSession
    # one row a written file: counts and ends, from the metadata columns alone
    parts = (spark.read.schema(COLUMNS).parquet(f"{path}/tokens").groupBy("part")
             .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
             .orderBy("part").collect())
    before = accumulate((r["n_tokens"] for r in parts), initial=0)
    held = [(r["part"], b, r["n_docs"], r["n_tokens"], r["first_id"], r["last_id"]) for r, b in zip(parts, before, strict=False)]
    spark.createDataFrame(held, "part int, before long, n_docs long, n_tokens long, first_id long, last_id long").coalesce(1).write.parquet(f"{path}/manifest")


def read_tokens(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids; with
    ``columns`` only those, so that metadata is read without any token.

    Filters on doc_id and n_tokens reach the page indexes.
    """
    tokens = spark.read.schema(COLUMNS).parquet(f"{path}/tokens")
    if columns and "start" not in columns:
        return tokens.select(*columns)
    before = spark.read.parquet(f"{path}/manifest").select("part", "before")
    found = tokens.join(before, "part").withColumn("start", F.col("start") + F.col("before"))
    return found.select(*(columns or ("doc_id", "start", "n_tokens", "ids")))


def read_window(spark: SparkSession, path: str, first: int, count: int) -> DataFrame:
    """start, ids: the tokens at places ``first`` to ``first + count`` of the
    whole stream, as one row a document that holds some of them."""
    until = first + count
    parts = spark.read.parquet(f"{path}/manifest").where((F.col("before") < until) & (F.col("before") + F.col("n_tokens") > first)).orderBy("part").collect()
    tokens = spark.read.schema(COLUMNS).parquet(f"{path}/tokens")
    if not parts:
        return tokens.select("start", "ids").limit(0)
    # constants reach the scan: parts by row group, places by page
    inside = None
    before = F.lit(0).cast("long")
    for r in (parts[0], parts[-1]) if len(parts) > 1 else parts:
        edge = (F.col("part") == r["part"]) & (F.col("start") < until - r["before"]) & (F.col("start") + F.col("n_tokens") > first - r["before"])
        inside = edge if inside is None else inside | edge
    if len(parts) > 2:
        inside = inside | F.col("part").between(parts[1]["part"], parts[-2]["part"])
    held = spark.createDataFrame([(r["part"], r["before"]) for r in parts], "part int, before long")
    found = tokens.where(F.col("part").between(parts[0]["part"], parts[-1]["part"]) & inside).join(held, "part")
    at, skip = F.col("start") + F.col("before"), F.greatest(F.lit(first) - F.col("start") - F.col("before"), before)
    size = F.least(F.col("n_tokens").cast("long"), F.lit(until) - F.col("start") - F.col("before")) - skip
    return found.where(size > 0).select((at + skip).alias("start"), F.slice("ids", (skip + 1).cast("int"), size.cast("int")).alias("ids"))


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of rows as `read_tokens` gives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(3)
            stops, ids = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(ids[i:j].data) for i, j in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2).cast(pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), path)
    return checksums(read_tokens(spark, path))
