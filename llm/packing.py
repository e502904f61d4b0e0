"""Packing documents into sequences, shortest pack first over lengths.

Each document is cut into whole sequences and a rest. Only the histogram of
rest lengths (one entry a length) reaches the driver, which places lengths
longest first, each time into the packs that are shortest so far, and keeps
counts of packs with the same filling instead of packs. The placements say
which ranks of a length go to which sequences; they are joined back to the
documents by length and rank.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import by_bytes, distinct, slices, store, table

SEQUENCE, SEPARATOR, VOCABULARY = 2048, 1, "word_bpe_49k.json"
#: Words a worker remembers the ids of before it forgets half of them.
MEMORY = 1_000_000
#: Text bytes a worker tokenises at a time (one long text more).
SLICE = 2_000_000


#: A single comma or full stop after a plain letter is a token of its own.
BLANK, COMMA, STOP, A, Z = b" ,.az"
#: Letters at a word's start (non-ASCII bytes are looked at as text), then ASCII signs.
LETTERS, SIGNS = re.compile(rb"[A-Za-z\x80-\xff]+"), re.compile(rb"[!-/:-@\[-`{-~]*")


class WordTokenizer:
    """Token ids of texts, remembering the ids of words.

    The vocabulary drops white space and joins no tokens across it, so a text's
    ids are those of its words between blanks and newlines one after the other.
    Plain lower-case words are tokenised together, and told apart again by the
    tokens that end a word; any other word is tokenised by itself.
    """

    def __init__(self, name: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(public_tokenizers.path(name))
        vocab = self.encoder.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.first, self.size, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0
        self.ids = np.zeros(1 << 20, np.uint32)

    def forget(self) -> None:
        """Keep the half that was met first: frequent words are met early."""
        words = list(self.place)[:len(self.place) // 2]
        first, size = self.first[:len(words)], self.size[:len(words)]
        ids = self.gather(first, size)
        self.clear()
        self.add_all(words, ids, np.cumsum(size))

    def learn(self, words: set[bytes]) -> None:
        """A word of letters and then signs is cut there, as the vocabulary's
        own splitting does; letters go in many words at a time, separated by
        blanks, and any other word by itself."""
        known, cut, odd = self.place, [], set()
        stems = {w for w in words if w.isalpha() and w.islower()}
        for w in words - stems:
            m = LETTERS.match(w)
            stem, tail = (m[0], w[m.end():]) if m else (b"", w)
            # as the vocabulary's normaliser leaves it: a letter that falls apart
            # into a letter and a mark changes where the word is cut
            if not stem or not SIGNS.fullmatch(tail) or not (stem.isalpha() or unicodedata.normalize("NFC", stem.decode("utf-8", "replace")).lower().isalpha()):
                odd.add(w)
                continue
            cut.append((w, stem := stem.lower(), tail))
            stems.add(stem)
            if tail:
                odd.add(tail)
        todo = sorted(w for w in stems if w not in known)
        for i in range(0, len(todo), 4000):
            part = todo[i:i + 4000]
            ids = np.array(self.encoder.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                self.add_all(part, ids, stops)
            else:  # a letter that the vocabulary's normaliser takes apart
                odd.update(part)
        todo = sorted(w for w in odd if w not in known)
        for i in range(0, len(todo), 4000):
            part = todo[i:i + 4000]
            found = [x.ids for x in self.encoder.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)]
            self.add_all(part, np.array([k for ids in found for k in ids], np.uint32), np.cumsum([len(ids) for ids in found]))
        new = [(w, known[stem], known[tail] if tail else -1) for w, stem, tail in cut if w not in known]
        if new:
            names, a, b = zip(*new, strict=True)
            a, b = np.array(a), np.array(b)
            size = np.stack([self.size[a], np.where(b < 0, 0, self.size[b])], 1).ravel()
            ids = self.gather(np.stack([self.first[a], self.first[b]], 1).ravel(), size)
            self.add_all(names, ids, np.cumsum(size)[1::2])

    def add_all(self, words, ids: np.ndarray, stops: np.ndarray) -> None:
        """Remember words whose ids stand one after the other."""
        k, n, m = len(self.place), len(words), len(ids)
        while k + n > len(self.first):
            self.first, self.size = np.resize(self.first, 2 * len(self.first)), np.resize(self.size, 2 * len(self.size))
        while self.used + m > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        starts = np.append(0, stops[:-1])
        self.ids[self.used:self.used + m] = ids
        self.first[k:k + n], self.size[k:k + n] = self.used + starts, stops - starts
        self.place.update(zip(words, range(k, k + n), strict=True))
        self.used += m

    def gather(self, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        return self.ids[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())]

    def split(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The distinct words of all texts, which of them stands at each place,
        and the first place of each text."""
        # the vocabulary is lower case; only its special tokens tell case apart
        data = b" " + b" ".join([t if b"<|" in t else t.lower() for t in texts]).replace(b"\n", b" ")
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        byte = np.frombuffer(data, np.uint8)
        opens = byte == BLANK
        after = opens[2:].copy()  # a text's end is no blank
        after[starts[starts >= 2] - 2] = False
        signs = 1 + np.flatnonzero(after & ((byte[1:-1] == COMMA) | (byte[1:-1] == STOP)))
        opens[signs[(byte[signs - 1] >= A) & (byte[signs - 1] <= Z)]] = True
        at = np.flatnonzero(opens)
        found, which = distinct(data, at)
        return [w.removeprefix(b" ") for w in found.to_numpy(zero_copy_only=False).tolist()], which, np.searchsorted(at, starts)

    def __call__(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if len(self.place) > MEMORY:
            self.forget()
        words, which, starts = self.split(texts)
        place = self.place
        missing = {w for w in words if w not in place}
        if missing:
            self.learn(missing)
        k = np.fromiter(map(place.__getitem__, words), np.int64, len(words))[which]
        size = self.size[k]
        ids, stops = self.gather(self.first[k], size), np.append(0, np.cumsum(size))
        for i, j in pairwise(stops[np.append(starts, len(k))].tolist()):
            yield ids[i:j]


_READY: dict[str, WordTokenizer] = {}


def _tokenizer(name: str) -> WordTokenizer:
    """One tokenizer a worker process, with what it remembers."""
    if name not in _READY:
        _READY[name] = WordTokenizer(name)
    return _READY[name]


def pieces(docs: DataFrame, size: int = SEQUENCE, vocabulary: str = VOCABULARY) -> DataFrame:
    """The documents' tokens, cut into pieces of ``size`` and a rest.

    bucket is the task that wrote the row, rank counts the pieces of the same
    length in it. ids are little-endian unsigned 32-bit integers.
    """
    columns = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
               ("ids", pa.binary()), ("bucket", pa.int64()), ("rank", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bucket, seen = _tokenizer(vocabulary), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for b in batches:
            doc_ids, texts = b.column(0).to_pylist(), [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            for i, j in slices([len(t) for t in texts], SLICE):
                rows = []
                for doc, ids in zip(doc_ids[i:j], encode(texts[i:j]), strict=True):
                    ids = np.append(ids, SEPARATOR).astype("<u4")
                    for start in range(0, len(ids), size):
                        part = ids[start:start + size].tobytes()
                        length = len(part) // 4
                        rows.append((doc, start, length, zlib.crc32(part), len(ids), part, bucket, int(seen[length])))
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), columns, strict=True)],
                                                 names=[n for n, _ in columns])
    return by_bytes(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, bucket long, rank long")


def place(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Placements (length, first rank, end rank, first sequence, offset).

    Longest lengths first; each goes to the packs with the most room while it
    fits there, else it opens new packs. Packs of equal room are kept as runs
    of sequence ids, so the work depends on the number of lengths only.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    out, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            most = max(room, default=0)
            if most >= length:
                base, n = room[most].pop()
                m = min(n, left)
                if m < n:
                    room[most].append((base + m, n - m))
                elif not room[most]:
                    del room[most]
            else:
                most, base, m = size, opened, left
                opened += m
            out.append((length, rank, rank + m, base, size - most))
            rank, left = rank + m, left - m
            if most > length:
                room.setdefault(most - length, []).append((base, m))
    return out


#: Placements that are sent to every task; with more, the join shuffles.
SENT = 100_000


def pack(docs: DataFrame, size: int = SEQUENCE, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, ids,
    sequence_id, offset.

    Null or empty text has the separator only. Repeated rows and null ids are
    packed as any row; other columns are ignored; an empty table has no pieces.
    """
    spark = docs.sparkSession
    rows = store(pieces(docs, size, vocabulary), "pieces")
    held = store(rows.groupBy("bucket", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = held.select("bucket", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    found = place(counts, size)
    placements = spark.createDataFrame(found, T.StructType([T.StructField(c, T.LongType()) for c in ("length", "low", "high", "base", "offset")]))
    if len(found) <= SENT:
        placements = F.broadcast(placements)
    ranked = rows.join(ahead, ["bucket", "length"]).withColumn("rank", F.col("rank") + F.col("ahead"))
    return (ranked.join(placements, "length").where("rank >= low AND rank < high")
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", (F.col("base") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents", "doc_id", "text")).drop("ids")
