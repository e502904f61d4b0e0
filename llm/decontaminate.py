"""Benchmark decontamination: a prefix-filtered containment join.

Every benchmark item gives windows of consecutive words. A window's tokens are
its word shingles; they are ordered by how rare they are in the whole corpus.
A document that contains a window contains all its tokens, so the rarest one,
the necessary prefix of an exact containment, is enough to find candidates. A
document position that holds that token fixes where the window would start;
candidates that would cross an end of the document are dropped, and the others
are compared word by word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import by_bytes, slices, store, table

WINDOW, SHINGLE = 10, 3
#: Windows of one index that is sent to the executors; a larger benchmark is
#: searched in blocks of about this many.
BLOCK = 200_000
#: Text bytes that a worker splits into words at a time (one long text more).
SLICE = 2_000_000

#: Words are runs of a-z, 0-9 and non-ASCII bytes; other bytes become blanks.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
MARK = b"|"  # never part of a word


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(words, items): each distinct window and the ids of its items."""
    def run(batches):
        for b in batches:
            ids, out = [], []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = (text or b"").translate(FOLD).split()
                seen = {b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else ()
                ids += [item] * len(seen)
                out += seen
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.binary())], names=["item", "words"])
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text").mapInArrow(run, "item string, words binary")
    return rows.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))


class Index:
    """The windows of one block as numbered words, with their shingle codes."""

    def __init__(self, rows: list) -> None:
        split = [r["words"].split(b" ") for r in rows]
        self.items = [r["items"] for r in rows]
        self.vocab = {w: i + 1 for i, w in enumerate(sorted({w for ws in split for w in ws}))}
        self.vocab[MARK] = -1
        self.base = len(self.vocab) + 1
        self.windows = [np.array([self.vocab[w] for w in ws]) for ws in split]
        #: tokens by shingle size: sorted distinct codes
        self.tokens = {}
        for s in range(1, SHINGLE + 1):
            own = [self.codes(w, s) for w in self.windows if min(SHINGLE, len(w)) == s]
            self.tokens[s] = np.unique(np.concatenate(own)) if own else np.zeros(0, np.int64)
        self.heads: dict[int, tuple] = {}

    def codes(self, ids: np.ndarray, s: int) -> np.ndarray:
        """One code for each s consecutive words; -1 where a word is unknown
        or a document ends."""
        n = len(ids) - s + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        code, whole = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(s):
            part = ids[k:n + k]
            code = code * self.base + part
            whole &= part > 0
        return np.where(whole, code, -1)

    def choose(self, counts: dict[int, np.ndarray]) -> None:
        """Keep each window's rarest token (ties: the first) as its prefix."""
        for s, tokens in self.tokens.items():
            found = []
            for k, w in enumerate(self.windows):
                if min(SHINGLE, len(w)) == s:
                    at = np.searchsorted(tokens, self.codes(w, s))
                    p = int(np.argmin(counts[s][at]))
                    found.append((at[p], k, p, len(w)))
            found = np.array(sorted(found), np.int64).reshape(-1, 4)
            heads, first = np.unique(found[:, 0], return_index=True)
            self.heads[s] = (tokens[heads], np.append(first, len(found)), found)

    def number(self, texts: list[bytes]) -> np.ndarray:
        words = (b" | ".join([t.translate(FOLD) for t in texts]) + b" |").split()
        get = self.vocab.get
        return np.array([get(w, 0) for w in words], np.int64)


def _find(sorted_codes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``codes`` that occur, and where they stand."""
    at = np.flatnonzero(codes >= 0)
    if not len(sorted_codes) or not len(at):
        return at[:0], at[:0]
    k = np.minimum(np.searchsorted(sorted_codes, codes[at]), len(sorted_codes) - 1)
    same = sorted_codes[k] == codes[at]
    return at[same], k[same]


def _texts(b: pa.RecordBatch, name: str) -> list[bytes]:
    return [t or b"" for t in b.column(b.schema.names.index(name)).cast(pa.binary()).to_pylist()]


def count_tokens(docs: DataFrame, index) -> DataFrame:
    """(size, token, n): how often each token of the block occurs in the corpus."""
    def run(batches):
        ix = index.value
        counts = {s: np.zeros(len(t), np.int64) for s, t in ix.tokens.items()}
        for b in batches:
            texts = _texts(b, "text")
            for i, j in slices([len(t) for t in texts], SLICE):
                ids = ix.number(texts[i:j])
                for s, t in ix.tokens.items():
                    if len(t):
                        counts[s] += np.bincount(_find(t, ix.codes(ids, s))[1], minlength=len(t))
        for s, c in counts.items():
            k = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), s, np.int32)), pa.array(k), pa.array(c[k])], names=["size", "token", "n"])
    return by_bytes(docs).select("text").mapInArrow(run, "size int, token long, n long").groupBy("size", "token").agg(F.sum("n").alias("n"))


def mark_block(docs: DataFrame, index, before: bool) -> DataFrame:
    """Add the block's hit spans and items, to those found ``before`` if any."""
    fields = {"n_words": "long", "spans": "array<struct<start:long,end:long>>", "items": "array<string>"}
    kept = [f for f in docs.schema.fields if f.name not in fields]
    schema = T.StructType(kept + [T.StructField(k, T._parse_datatype_string(v)) for k, v in fields.items()])
    keep = [f.name for f in kept]

    def run(batches):
        ix = index.value
        for b in batches:
            texts = _texts(b, "text")
            old = [b.column(b.schema.names.index(c)).to_pylist() for c in ("spans", "items")] if before else [[[]] * len(texts)] * 2
            n_words, spans, items = [], [], []
            for i, j in slices([len(t) for t in texts], SLICE):
                for n, new_spans, wins in _search(ix, texts[i:j]):
                    k = len(n_words)
                    n_words.append(n)
                    spans.append(_union([(x["start"], x["end"]) for x in old[0][k]] + new_spans))
                    items.append(sorted({*old[1][k], *(x for w in wins for x in ix.items[w])}))
            new = [pa.array(n_words, pa.int64()),
                   pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                   pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.names.index(c)) for c in keep] + new, names=[*keep, *fields])
    return by_bytes(docs).mapInArrow(run, schema)


def _search(ix: Index, texts: list[bytes]) -> Iterator[tuple[int, list, set]]:
    """Per text: number of words, hit spans, windows that occur."""
    ids = ix.number(texts)
    ends = np.flatnonzero(ids == -1)
    starts = np.append(0, ends[:-1] + 1)
    hits: dict[int, list] = {}
    for s, (heads, first, found) in ix.heads.items():
        at, k = _find(heads, ix.codes(ids, s))
        if not len(at):
            continue
        times = first[k + 1] - first[k]
        pick = np.repeat(first[k], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        _, win, p, size = found[pick].T
        start = np.repeat(at, times) - p
        doc = np.searchsorted(ends, np.repeat(at, times))
        inside = (start >= starts[doc]) & (start + size <= ends[doc])
        for n in np.unique(size[inside]):
            own = inside & (size == n)
            w, st, dc = win[own], start[own], doc[own]
            table_of = {x: r for r, x in enumerate(np.unique(w))}
            rows = np.stack([ix.windows[x] for x in table_of])
            same = (ids[st[:, None] + np.arange(n)] == rows[[table_of[x] for x in w]]).all(1)
            for d, x, y in zip(dc[same].tolist(), st[same].tolist(), w[same].tolist(), strict=True):
                hits.setdefault(d, []).append((x - int(starts[d]), x - int(starts[d]) + int(n), y))
    for d in range(len(texts)):
        own = hits.get(d, [])
        yield int(ends[d] - starts[d]), [(x, y) for x, y, _ in own], {y for *_, y in own}


def _union(spans: list) -> list:
    out: list = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """All columns of ``docs`` plus n_words, spans, items, n_hit.

    spans are the maximal word ranges covered by benchmark windows, items the
    ids (as strings, sorted) of items with an occurring window, n_hit the words
    inside spans. Columns of those names in ``docs`` are replaced. Null or
    empty text has no words; an item without words has no window; a null item
    id is called "null"; repeated items and windows count once. Every row is
    judged alone, so repeated rows and null ids pass through.

    An index holds at most about ``block`` windows of ``size`` words; a larger
    benchmark is searched in several passes, each adding its hits to the rows.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_words", "spans", "items", "n_hit")
    win = store(windows(benchmark, size), "windows")
    total = win.count()
    blocks = max(1, math.ceil(total / block))
    numbered = win.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)))
    texts = docs
    for k in range(blocks):
        ix = Index(numbered.where(F.col("block") == k).select("words", "items").collect())
        counts = {s: np.zeros(len(t), np.int64) for s, t in ix.tokens.items()}
        for s, token, n in count_tokens(texts, spark.sparkContext.broadcast(ix)).collect():
            counts[s][token] = n
        ix.choose(counts)
        docs = mark_block(docs, spark.sparkContext.broadcast(ix), k > 0)
        if k < blocks - 1:  # one block's work is done once
            docs = store(docs, "marked")
    return docs.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_SQL = rf"""
WITH b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[i + 1 : i + {WINDOW}], ' ') AS s, least(len(w), {WINDOW}) AS n
  FROM b, range(0, greatest(1, len(w) - {WINDOW - 1})) r(i) WHERE len(w) > 0),
d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS s
  FROM d, sizes, range(0, greatest(0, len(w) - n + 1)) r(i)),
hit AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN win ON win.n = dw.n AND win.s = dw.s),
words AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, range(0, n) r(k) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
