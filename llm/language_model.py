"""Context-tree weighting over binary-decomposed bytes.

A text is its lower-cased UTF-8 bytes and an end. Each byte is a path of eight
binary decisions; the context of each is the path so far and the bytes before
it, up to DEPTH.

Counts cover the whole training text, and every context of it is kept. Each
context's Krichevsky-Trofimov estimate is weighted half and half with the
product of its children, from the deepest contexts up; the weights turn the
counts into one probability a decision. Cells (a context of DEPTH bytes and
the byte after it) are dealt by their nearest bytes, so that a task has all
longer contexts of those it weighs; the contexts of up to TOP bytes, which
the alphabet bounds, are weighed on the driver. Texts look up the cells that
occur most, which every task is sent, and are joined with the others.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import by_bytes, distinct, held_out, slices, store, table

FOLDS = 10
#: Bytes of context; decisions a byte, and the last byte.
DEPTH, WIDTH, LAST = 6, 8, 255
#: The small tree's symbols, which rare bytes share.
BITS, SYMBOLS = 6, 64
#: Words whose counts, and cells whose scores every task is sent; the others
#: are joined.
WORDS, SENT = 65_536, 1_000_000
#: Bytes of the contexts that the driver weighs; cells for a task, and those
#: of them that it weighs at a time.
TOP, SHARE, RUN = 2, 1_000_000, 250_000
#: Text bytes a worker counts or scores at a time, and keys it gathers before
#: it adds up equal ones.
SLICE, GATHER = 2_000_000, 4_000_000
#: Bits for a count below its key while a worker gathers keys, and the largest.
TALLY, MOST = 7, 127
END = 255  # never a byte of UTF-8
PRIOR = 0.1


def _symbol_table() -> np.ndarray:
    """Symbol of each byte: a-z 0 to 25, blank, newline, end, full stop,
    comma, digits, other ASCII, lead byte 195, other lead bytes, continuation
    bytes below 160, and 160 to 191 on 28 symbols."""
    s = np.full(256, 32)
    s[97:123] = np.arange(26)
    for k, c in enumerate((32, 10, END, 46, 44)):
        s[c] = 26 + k
    s[48:58] = 31
    s[192:255] = 34
    s[195] = 33
    s[128:160] = 35
    s[160:192] = 36 + np.arange(32) * 28 // 32
    return s


SYMBOL = _symbol_table()
BLANK = int(SYMBOL[32])
#: What ``score`` takes for symbols: every byte by itself.
BYTES = np.arange(256)


def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes, each with an end, and where each text starts."""
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    return np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8), starts


def before(symbol: np.ndarray, starts: np.ndarray, back: int, blank: int = BLANK) -> np.ndarray:
    """The symbol ``back`` places earlier; a blank before a text's start."""
    out = np.full(len(symbol), blank, symbol.dtype)
    out[back:] = symbol[:-back]
    for k in range(back):
        at = starts + k
        out[at[at < len(out)]] = blank
    return out


def keys(texts: list[bytes], of: np.ndarray = SYMBOL, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Context and symbol of each place in one number (the nearest symbol in
    the lowest bits of the context, the symbol below it), and the bytes."""
    data, starts = symbols(texts)
    symbol = of[data]
    key = symbol.astype(np.int64)
    for back in range(1, DEPTH + 1):
        key |= before(symbol, starts, back, of[32]).astype(np.int64) << (bits * back)
    return key, data


def byte_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``keys`` over bytes, and where each text starts: a place's key is the
    big-endian number of the bytes up to it."""
    blanks = b" " * DEPTH
    data = blanks + b" " + (b"\xff" + blanks).join(texts) + b"\xff"
    wide = np.empty(len(data) - 7, np.int64)  # all eight bytes from each place on
    for k in range(min(8, len(wide))):
        wide[k::8] = np.frombuffer(data, ">i8", -(-(len(wide) - k) // 8), k)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    kept = np.ones(len(wide), bool)
    kept[((starts + DEPTH * np.arange(len(starts)))[1:, None] - 1 - np.arange(DEPTH)).ravel()] = False
    return wide[kept] & ((1 << WIDTH * (DEPTH + 1)) - 1), starts


def add_up(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
    return key[first], np.add.reduceat(n, first) if len(key) else n


def tally(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adds up, in their own memory, numbers of a key and a count below it:
    sorted distinct ones, and keys and counts of what is above MOST."""
    packed.sort()
    first = np.flatnonzero(np.append(True, (packed[1:] ^ packed[:-1]) > MOST)) if len(packed) else np.zeros(0, int)
    key = packed[first] >> TALLY
    packed &= MOST
    n = np.add.reduceat(packed, first) if len(first) else packed
    above = np.flatnonzero(n > MOST)
    rest = key[above], n[above] - MOST
    key <<= TALLY
    key |= np.minimum(n, MOST, out=n)
    return key, *rest


def _lower(b: pa.RecordBatch, i: int) -> list[bytes]:
    return [(t or b"").lower() for t in b.column(i).cast(pa.binary()).to_pylist()]


def _lists(bounds: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def count_contexts(docs: DataFrame, of: np.ndarray = SYMBOL, bits: int = BITS) -> DataFrame:
    """(key, n) over all texts; a negative key counts a byte by itself."""
    whole = of is BYTES and (lambda texts: (key := byte_keys(texts)[0], key & LAST))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(key, n):
            for i in range(0, len(key), RUN):
                yield pa.RecordBatch.from_arrays([pa.array(key[i:i + RUN]), pa.array(n[i:i + RUN])], names=["key", "n"])

        def merge():
            packed = np.concatenate(parts)
            parts.clear()
            packed, *more = tally(packed)
            parts.append(packed)
            above.append(more)

        parts, above, size, plain = [], [], 0, np.zeros(256, np.int64)
        for b in batches:
            texts = _lower(b, 0)
            for i, j in slices([len(t) for t in texts], SLICE):
                key, data = whole(texts[i:j]) if whole else keys(texts[i:j], of, bits)
                plain += np.bincount(data, minlength=256)
                key <<= TALLY
                key |= 1
                packed, *more = tally(key)
                del key, data
                parts.append(packed)
                above.append(more)
                size += len(packed)
                if size > GATHER:
                    merge()
                    size = len(parts[0])
                    if size > GATHER // 2:
                        packed, size = parts.pop(), 0
                        yield from rows(packed >> TALLY, packed & MOST)
                    above = [add_up(*(np.concatenate(x) for x in zip(*above, strict=True)))]
        if parts:
            merge()
            yield from rows(parts[0] >> TALLY, parts[0] & MOST)
        above.append((np.arange(256) - 256, plain))
        yield from rows(*add_up(*(np.concatenate(x) for x in zip(*above, strict=True))))
    return by_bytes(docs).select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b" " * 5)


def words_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of all texts and an empty one, which of them stands
    at each word's place, and the first place of each text, with their end."""
    data = b" " + b" ".join(texts).translate(SPACES)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    at = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    words, which = distinct(data, at)
    full = np.diff(at, append=len(data)) > 1
    return [w[1:] for w in words.to_numpy(zero_copy_only=False).tolist()], which[full], np.append(np.searchsorted(at[full], starts), full.sum())


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
        counts: Counter = Counter()
        for b in batches:
            texts = _lower(b, 0)
            for i, j in slices([len(t) for t in texts], SLICE):
                words, which, _ = words_of(texts[i:j])
                for w, n in zip(words, np.bincount(which, minlength=len(words)).tolist(), strict=True):
                    if n:
                        counts[w] += n
                if len(counts) > GATHER // 8:
                    yield rows()
                    counts.clear()
        yield rows()
    return by_bytes(docs).select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_seen(counted: DataFrame, most: int) -> DataFrame:
    """The rows with the largest ``n``, at most ``most`` of them: those from
    the lowest eighth of a power of two on that leaves no more."""
    step = F.floor(F.log2("n") * 8)
    left, least = most, None
    for r in sorted(counted.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True):
        if r["k"] > left:
            break
        left, least = left - r["k"], r["s"]
    return counted.where(F.lit(False) if least is None else step >= least)


# ---------------------------------------------------------------- the tree

def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after moving x up by 6."""
    y = x + 6
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - z * (1 / 360 - z / 1260)) / y - np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))


def decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at the 63 decisions (decision k is followed by 2k and
    2k+1) from symbol counts of shape (contexts, 64)."""
    total = np.zeros((len(counts), 2 * SYMBOLS))
    total[:, SYMBOLS:] = counts
    for k in range(SYMBOLS - 1, 0, -1):
        total[:, k] = total[:, 2 * k] + total[:, 2 * k + 1]
    return total[:, 2::2], total[:, 3::2]


def estimate(zero: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Krichevsky-Trofimov: probability of a one next, log of what was seen."""
    return (one + 0.5) / (zero + one + 1), _log_gamma(zero + 0.5) + _log_gamma(one + 0.5) - np.log(np.pi) - _log_gamma(zero + one + 1)


def symbol_logs(p_one: np.ndarray) -> np.ndarray:
    """log2 probability of the 64 symbols from 63 probabilities of a one."""
    out = np.zeros((len(p_one), 2 * SYMBOLS), np.float32)
    for k in range(1, SYMBOLS):
        out[:, 2 * k] = out[:, k] + np.log2(1 - p_one[:, k - 1])
        out[:, 2 * k + 1] = out[:, k] + np.log2(p_one[:, k - 1])
    return out[:, SYMBOLS:]


# ------------------------------------------- every context, over all tasks

def turned(key: np.ndarray) -> np.ndarray:
    """Keys with the nearest byte highest and the coded one lowest: a
    context's shorter contexts are its prefixes."""
    out = key & LAST
    for back in range(1, DEPTH + 1):
        out |= ((key >> WIDTH * back) & LAST) << WIDTH * (DEPTH + 1 - back)
    return out


def climb(j: int, depth: int, least: int, k: np.ndarray, zero: np.ndarray, one: np.ndarray, below: np.ndarray | None) -> tuple[list, tuple]:
    """Weigh decision ``j`` of a byte's path in the contexts of ``depth``
    down to ``least`` bytes: estimate, weight and place of the next shorter
    context, a level each, and (k, zero, one, below) of the level after.

    ``k`` is the context and the ``j`` decisions before, ``below`` the log of
    the product of the children; the longest contexts have none.
    """
    levels = []
    for _ in range(depth, least - 1, -1):
        p, log_p = estimate(zero, one)
        weight = np.ones(len(p))
        if below is not None:
            both = np.logaddexp(log_p, below) - np.log(2)
            weight, log_p = np.exp(log_p - np.log(2) - both), both
        k, at = np.unique((k >> (j + WIDTH) << j) | (k & ((1 << j) - 1)), return_inverse=True)
        levels.append((p, weight, at))
        zero, one, below = (np.bincount(at, x, len(k)) for x in (zero, one, log_p))
    return levels, (k, zero, one, below)


def descend(levels: list, mixed: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mixture over all shorter contexts, and the weight that is left."""
    for p, weight, at in reversed(levels):
        mixed, left = mixed[at] + left[at] * weight * p, left[at] * (1 - weight)
    return mixed, left


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list]]:
    """A task's cells in order, those of one longer context than the driver's
    together, and for each decision its bits, places and levels."""
    parts = [[c.to_numpy() for c in b.columns] for b in batches]
    if not parts:
        return
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    r = turned(columns[0])
    order = np.argsort(r)
    r, columns = r[order], [c[order] for c in columns]
    context = r >> WIDTH * (DEPTH - TOP)
    starts = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
    sizes = np.diff(np.append(starts, len(r)))
    for i, j in slices(sizes.tolist(), RUN):
        own = slice(starts[i], starts[j - 1] + sizes[j - 1])
        yield [c[own] for c in columns], list(weighed(r[own], columns[1][own].astype(float)))


def weighed(r: np.ndarray, n: np.ndarray) -> Iterator[tuple]:
    for j in range(WIDTH):
        k, bit = r >> (WIDTH - j), (r >> (WIDTH - 1 - j)) & 1
        new = np.append(True, k[1:] != k[:-1])
        first = np.flatnonzero(new)
        one = np.add.reduceat(n * bit, first)
        yield bit == 1, np.cumsum(new) - 1, *climb(j, DEPTH, TOP + 1, k[first], np.add.reduceat(n, first) - one, one, None)


def cell_scores(learn: DataFrame, docs: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """(key, n, log) of every cell of ``docs``: how often it occurs there, and
    the log2 probability of its byte after all of ``learn``. Cells that
    ``learn`` lacks count 0 there. If ``docs`` are ``learn`` and ``others``,
    nothing is counted twice."""
    spark = docs.sparkSession
    none = F.lit(0).cast("long")
    learnt = count_contexts(learn, BYTES, WIDTH).select("key", "n", (none if others is None else F.col("n")).alias("m"))
    here = count_contexts(docs if others is None else others, BYTES, WIDTH).select("key", none.alias("n"), F.col("n").alias("m"))
    both = learnt.unionByName(here).where("key >= 0")
    cells = store(both.groupBy("key").agg(F.sum("n").alias("n"), F.sum("m").alias("m")), "cells")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-cells.count() // SHARE))
    dealt = cells.repartition(tasks, F.shiftright("key", WIDTH).bitwiseAND(F.lit((1 << WIDTH * (TOP + 1)) - 1)))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in runs(batches):
            for j, (_, _, _, (k, zero, one, below)) in enumerate(found):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), j, np.int32)), pa.array(k), pa.array(zero), pa.array(one), pa.array(below)],
                                                 names=["j", "k", "zero", "one", "below"])
    top = (dealt.mapInArrow(short, "j int, k long, zero double, one double, below double").groupBy("j", "k")
           .agg(*[F.sum(c).alias(c) for c in ("zero", "one", "below")]).toArrow())
    decision, *columns = (c.to_numpy() for c in top.columns)
    known = []
    for j in range(WIDTH):
        at = np.flatnonzero(decision == j)
        k, zero, one, below = (c[at[np.argsort(columns[0][at])]] for c in columns)
        levels, (ends, *_) = climb(j, TOP, 0, k, zero, one, below)
        known.append((k, *descend(levels, np.zeros(len(ends)), np.ones(len(ends)))))
    shared = spark.sparkContext.broadcast(known)

    def logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, _, m), found in runs(batches):
            out = np.zeros(len(key))
            for (bit, at, levels, (k, *_)), (has, mixed, left) in zip(found, shared.value, strict=True):
                place = np.searchsorted(has, k)
                p = descend(levels, mixed[place], left[place])[0][at]
                out += np.log2(np.where(bit, p, 1 - p))
            kept = m > 0
            yield pa.RecordBatch.from_arrays([pa.array(key[kept]), pa.array(m[kept]), pa.array(out[kept].astype(np.float32))], names=["key", "n", "log"])
    return store(dealt.mapInArrow(logs, "key long, n long, log float"), "logs")


# ------------------------------------------------- a tree in one process

def inner_logs(plain: np.ndarray) -> np.ndarray:
    """log2 probability of a byte among the bytes of its symbol, one decision
    after the other, from the bytes' counts."""
    out = np.zeros(256, np.float32)
    for s in range(SYMBOLS):
        members = np.flatnonzero(SYMBOL == s)
        share = 0.0
        for i, c in enumerate(members[:-1]):
            after = plain[members[i + 1:]].sum()
            p = (plain[c] + 0.5) / (plain[c] + after + 1)
            out[c] = share + np.log2(p)
            share += np.log2(1 - p)
        if len(members):
            out[members[-1]] = share
    return out


class ContextTree:
    """Nodes are contexts, the root is 0; ``child`` leads from a node by the
    next symbol back, -1 where that context is not kept."""

    def __init__(self, depth: np.ndarray, context: np.ndarray) -> None:
        order = np.lexsort((context, depth))
        self.depth = np.append(0, depth[order])
        context = np.append(0, context[order])
        self.child = np.full((len(context), SYMBOLS), -1, np.int32)
        self.parent = np.zeros(len(context), np.int64)
        for d in range(1, DEPTH + 1):
            own, up = np.flatnonzero(self.depth == d), np.flatnonzero(self.depth == d - 1)
            if len(own):  # every parent is seen as often as its child at least
                self.parent[own] = up[np.searchsorted(context[up], context[own] & ((1 << BITS * (d - 1)) - 1))]
                self.child[self.parent[own], context[own] >> BITS * (d - 1)] = own

    def __getstate__(self) -> dict:
        """What a task needs, compressed: each executor keeps a copy on disk."""
        sent = {k: getattr(self, k) for k in ("child", "logs", "inner") if hasattr(self, k)}
        return {k: (zlib.compress(v.tobytes(), 1), v.dtype.str, v.shape) for k, v in sent.items()}

    def __setstate__(self, sent: dict) -> None:
        for k, (data, kind, shape) in sent.items():
            setattr(self, k, np.frombuffer(zlib.decompress(data), kind).reshape(shape))

    def walk(self, steps) -> np.ndarray:
        """The deepest kept node of each place; ``steps`` gives the symbols
        one, two, ... places back."""
        node = alive = None
        for s in steps:
            if node is None:
                node, alive = np.zeros(len(s), np.int64), np.arange(len(s))
            below = self.child[node[alive], s[alive]]
            alive, below = alive[below >= 0], below[below >= 0]
            node[alive] = below
        return node

    def fit(self, counts: np.ndarray, plain: np.ndarray) -> None:
        """``counts``: symbols by the node their walk ends at; ``plain``: bytes."""
        n = len(counts)
        leaf = (self.child < 0).all(1)
        total = counts.copy()
        log_p, weight = np.zeros((n, SYMBOLS - 1), np.float32), np.ones((n, SYMBOLS - 1), np.float32)
        for d in range(DEPTH, -1, -1):  # log_p holds the product of the children so far
            for own in np.array_split(np.flatnonzero(self.depth == d), 1 + (self.depth == d).sum() // 20_000):
                _, seen = estimate(*decisions(total[own].astype(float)))
                inner = ~leaf[own]
                k = own[inner]
                below = log_p[k].astype(float) + estimate(*decisions(counts[k]))[1]
                both = np.logaddexp(seen[inner], below) - np.log(2)
                weight[k] = np.exp(seen[inner] - np.log(2) - both)
                seen[inner] = both
                if d:
                    np.add.at(total, self.parent[own], total[own])
                    np.add.at(log_p, self.parent[own], seen)
        del log_p
        mixed, left = np.zeros((n, SYMBOLS - 1), np.float32), np.ones((n, SYMBOLS - 1), np.float32)
        self.logs = np.zeros((n, SYMBOLS), np.float32)
        for d in range(DEPTH + 1):
            for own in np.array_split(np.flatnonzero(self.depth == d), 1 + (self.depth == d).sum() // 20_000):
                up = self.parent[own]
                m, rest = (mixed[up], left[up]) if d else (mixed[own], left[own])
                mixed[own] = m + rest * weight[own] * estimate(*decisions(total[own]))[0]
                left[own] = rest * (1 - weight[own])
                self.logs[own] = symbol_logs(mixed[own] + left[own] * estimate(*decisions(counts[own]))[0])
        self.inner = inner_logs(plain)

    def log10(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each lower-cased text with its end."""
        data, starts = symbols(texts)
        symbol = SYMBOL[data]
        node = self.walk(before(symbol, starts, k) for k in range(1, DEPTH + 1))
        return np.add.reduceat(self.logs[node, symbol] + self.inner[data], starts, dtype=np.float64) * np.log10(2)


def train(docs: DataFrame, nodes: int) -> ContextTree:
    """A tree of the ``nodes`` contexts that all texts of ``docs`` have most,
    over folded symbols, to look at or compare with: ``score`` does without it.
    Without any text it says one half."""
    spark = docs.sparkSession
    counted = store(count_contexts(docs), "contexts")
    seen, level = counted.where("key >= 0"), None
    kept = None
    for d in range(DEPTH, 0, -1):
        context = F.shiftright("key", BITS) if level is None else F.col("context").bitwiseAND(F.lit((1 << BITS * d) - 1))
        level = store((seen if level is None else level).groupBy(context.alias("context")).agg(F.sum("n").alias("n")), "level")
        here = level.select(F.lit(d).alias("depth"), "context", "n")
        kept = here if kept is None else kept.unionByName(here)
    rows = most_seen(kept, nodes).select("depth", "context").toArrow()  # columns, not a row object each
    tree = ContextTree(rows["depth"].to_numpy().astype(np.int64), rows["context"].to_numpy())
    shared = spark.sparkContext.broadcast(tree)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, n = (b.column(i).to_numpy() for i in range(2))
            node = shared.value.walk((key >> BITS * k) & (SYMBOLS - 1) for k in range(1, DEPTH + 1))
            key, n = add_up(node * SYMBOLS + (key & (SYMBOLS - 1)), n)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["cell", "n"])
    cells = seen.mapInArrow(ends, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(tree.child) * SYMBOLS, np.float32)
    counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    plain = np.zeros(256)
    for key, n in counted.where("key < 0").collect():
        plain[key + 256] = n
    tree.fit(counts.reshape(-1, SYMBOLS), plain)
    return tree


def score(docs: DataFrame, learn: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each row
    of ``docs``, learning from the texts of ``learn``. ``others`` may name the
    rows of ``docs`` besides those of ``learn``, if it has all of these.

    Null and empty texts have the end only. Rows are scored one by one, so
    repeated rows and null ids stay; other columns are ignored. With nothing to
    learn from, every count is 0 and every decision one half.
    """
    spark = docs.sparkSession
    cells = cell_scores(learn, docs, others)
    most = most_seen(cells, SENT).select("key", "log").toArrow()
    most_keys, most_logs = (c.to_numpy() for c in most.columns)
    order = np.argsort(most_keys)
    shared = spark.sparkContext.broadcast((most_keys[order], most_logs[order]))
    counted = store(count_words(learn), "words")
    n_docs = learn.count()
    total, distinct = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("word")).first()
    total, distinct = total + n_docs, distinct + (n_docs > 0)
    common = {bytes(w): n for w, n in most_seen(counted, WORDS).collect()}
    common_shared = spark.sparkContext.broadcast(common)
    below = np.log10(total + PRIOR * (distinct + 1))
    end = float(np.log10(n_docs + PRIOR) - below)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has, log = pd.Index(shared.value[0]), np.append(shared.value[1], 0)
        logs = {w: float(np.log10(n + PRIOR) - below) for w, n in common_shared.value.items()}
        row = TaskContext.get().partitionId() << 36
        for b in batches:
            doc_ids, texts = b.column(0), _lower(b, 1)
            for i, j in slices([len(t) for t in texts], SLICE):
                part = texts[i:j]
                key, starts = byte_keys(part)
                place = has.get_indexer(key)  # -1: not among them
                total_logs = np.add.reduceat(log[place], starts, dtype=np.float64) * np.log10(2)
                others = np.flatnonzero(place < 0)
                cells_of = _lists(np.searchsorted(others, np.append(starts, len(key))), pa.array(key[others]))
                words, which, ends = words_of(part)
                value = np.array([logs.get(w, np.nan) for w in words])[which]
                rare = np.isnan(value)
                heard, until = value[~rare].tolist(), np.append(0, np.cumsum(~rare))[ends]
                base = [sum(heard[x:y]) + end for x, y in pairwise(until.tolist())]
                at = np.flatnonzero(rare)
                pair, times = np.unique((np.searchsorted(ends, at, "right") - 1) * len(words) + which[at], return_counts=True)
                bounds = np.searchsorted(pair, np.arange(len(part) + 1) * len(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(part))), doc_ids[i:j], pa.array(np.diff(ends) + 1), pa.array(np.diff(until) + (n_docs > 0)), pa.array(base, pa.float64()), pa.array(total_logs),
                     _lists(bounds, pa.array(words, pa.binary()).take(pa.array(pair % len(words)))), _lists(bounds, pa.array(times)), cells_of],
                    names=["row", "doc_id", "n_tokens", "known", "base", "score", "rare", "times", "cells"])
                row += len(part)
    rows = store(by_bytes(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "row long, doc_id long, n_tokens long, known long, base double, score double, rare array<binary>, times array<long>, cells array<long>"), "scored")
    rare = (rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x"))
            .select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times")))
    share = F.log10(F.coalesce("n", F.lit(0)) + PRIOR) - F.lit(float(below))
    added = (rare.join(counted, "word", "left").groupBy("row")
             .agg(F.sum(F.col("times") * share).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("also")))
    further = (rows.select("row", F.explode("cells").alias("key")).join(cells.select("key", "log"), "key").groupBy("row")
               .agg((F.sum("log") * F.lit(float(np.log10(2)))).alias("further")))
    return (rows.drop("rare", "times", "cells").join(added, "row", "left").join(further, "row", "left")
            .select("doc_id", "n_tokens", (F.col("known") + F.coalesce("also", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
                    (F.col("score") + F.coalesce("further", F.lit(0.0))).alias("score")))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = held_out(F.col("doc_id"), FOLDS)
    return score(docs, docs.where(~out), docs.where(out)).select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
