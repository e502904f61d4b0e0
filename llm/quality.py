"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in turn over one feature after the other, then over
the pairs of features with the strongest interaction. All trees of a feature
add up to one lookup table over its bins, all trees of a pair to one table
over both bins, so a score is a sum of table entries.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import by_bytes, held_out, table

#: At most so many labelled documents are learnt from (the smallest hashes of
#: their ids); the model's size does not depend on the data.
MAX_LABELS = 20_000
FOLDS, THRESHOLD = 5, 0.3

FEATURES = ("log_bytes", "upper", "lower", "digit", "space", "newline", "non_ascii", "comma_dot", "symbol", "bar",
            "bang", "log_words", "distinct_words", "top_word", "word_bytes", "longest_word", "symbol_end",
            "log_lines", "repeated_lines", "line_words")


def _class_table() -> np.ndarray:
    """256 x 9 membership of byte values in the counted classes."""
    c = np.arange(256)
    return np.stack([(c >= 65) & (c <= 90), (c >= 97) & (c <= 122), (c >= 48) & (c <= 57), (c == 32) | (c == 9), c == 10, c >= 128,
                     (c == 44) | (c == 46), (c >= 33) & (c < 127) & ~np.isin(c, np.frombuffer(b",.!|", np.uint8)) & ~((c >= 48) & (c <= 57))
                     & ~((c >= 65) & (c <= 90)) & ~((c >= 97) & (c <= 122)), c == 124, c == 33], 1).astype(float)


CLASSES = _class_table()
SYMBOLS = frozenset(b"#$%&*+<=>@\\^_`{|}~!")


def features(text: bytes) -> list[float]:
    """The feature vector of one whole text, in the order of FEATURES."""
    n = len(text)
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ CLASSES / max(n, 1)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    counts, w = Counter(words), max(len(words), 1)
    return [np.log1p(n), *shares, np.log1p(len(words)), len(counts) / w, max(counts.values(), default=0) / w,
            sum(map(len, words)) / w, max(map(len, counts), default=0), sum(m for x, m in counts.items() if x[-1] in SYMBOLS) / w,
            np.log1p(len(lines)), 1 - len(set(lines)) / max(len(lines), 1), len(words) / max(len(lines), 1)]


class PairwiseGam:
    """Cyclic gradient boosting of tables over binned features and pairs."""

    def __init__(self, bins: int = 24, rounds: int = 120, pairs: int = 8, pair_rounds: int = 60, rate: float = 0.1, ridge: float = 2.0) -> None:
        self.bins, self.rounds, self.n_pairs, self.pair_rounds, self.rate, self.ridge = bins, rounds, pairs, pair_rounds, rate, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> PairwiseGam:
        """Without rows of both labels the score is the smoothed share of 1."""
        share = (y.sum() + 1) / (len(y) + 2)
        self.base, self.cuts, self.tables, self.pairs, self.pair_tables = float(np.log(share / (1 - share))), [], [], [], []
        if len(np.unique(y)) < 2:
            return self
        self.cuts = [np.unique(np.quantile(c, np.arange(1, self.bins) / self.bins)) for c in x.T]
        b, k = self.binned(x), self.bins
        self.tables = [np.zeros(k) for _ in self.cuts]
        raw = np.full(len(y), self.base)
        for _ in range(self.rounds):
            for f, t in enumerate(self.tables):
                step = self.rate * self.tree(*self.gradients(b[:, f], raw, y, k))
                t += step
                raw += step[b[:, f]]
        strength = []
        for i in range(len(self.cuts)):
            for j in range(i):
                g, h = self.gradients(b[:, i] * k + b[:, j], raw, y, k * k)
                strength.append((-self.quadrants(g.reshape(k, k), h.reshape(k, k))[0], i, j))
        self.pairs = [(i, j) for _, i, j in sorted(strength)[:self.n_pairs]]
        self.pair_tables = [np.zeros(k * k) for _ in self.pairs]
        for _ in range(self.pair_rounds):
            for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
                cell = b[:, i] * k + b[:, j]
                g, h = self.gradients(cell, raw, y, k * k)
                step = self.rate * self.quadrants(g.reshape(k, k), h.reshape(k, k))[1].ravel()
                t += step
                raw += step[cell]
        return self

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, side="right") for c, v in zip(self.cuts, x.T, strict=True)], 1)

    def gradients(self, cell, raw, y, size):
        p = 1 / (1 + np.exp(-raw))
        return np.bincount(cell, y - p, size), np.bincount(cell, p * (1 - p), size)

    def tree(self, g, h, depth: int = 2) -> np.ndarray:
        """Values a bin of the tree with the best cuts on sums g and h."""
        value = np.full(len(g), g.sum() / (h.sum() + self.ridge))
        if depth == 0 or len(g) < 2:
            return value
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = gl ** 2 / (hl + self.ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + self.ridge)
        c = int(gain.argmax()) + 1
        return np.concatenate([self.tree(g[:c], h[:c], depth - 1), self.tree(g[c:], h[c:], depth - 1)])

    def quadrants(self, g, h):
        """Gain and values of the best cut of both axes into four leaves."""
        k = len(g)
        cum = lambda a: np.cumsum(np.cumsum(a, 0), 1)
        G, H = cum(g), cum(h)
        corner = lambda a: (a[:-1, :-1], a[:-1, -1:] - a[:-1, :-1], a[-1:, :-1] - a[:-1, :-1], a[-1, -1] - a[:-1, -1:] - a[-1:, :-1] + a[:-1, :-1])
        leaves = list(zip(corner(G), corner(H), strict=True))
        gain = sum(p ** 2 / (q + self.ridge) for p, q in leaves) - g.sum() ** 2 / (h.sum() + self.ridge)
        r, c = np.unravel_index(gain.argmax(), gain.shape)
        v = [p[r, c] / (q[r, c] + self.ridge) for p, q in leaves]
        low, left = np.arange(k)[:, None] <= r, np.arange(k)[None, :] <= c
        return gain[r, c], np.where(low, np.where(left, v[0], v[1]), np.where(left, v[2], v[3]))

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.full(len(x), self.base)
        if self.cuts and len(x):
            b = self.binned(x)
            for f, t in enumerate(self.tables):
                raw += t[b[:, f]]
            for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
                raw += t[b[:, i] * self.bins + b[:, j]]
        return 1 / (1 + np.exp(-raw))


def _vectors(b: pa.RecordBatch) -> np.ndarray:
    texts = b.column(b.schema.names.index("text")).cast(pa.binary()).to_pylist()
    return np.array([features(t or b"") for t in texts], float).reshape(len(texts), len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, folds: int = FOLDS) -> PairwiseGam:
    """Fit on documents whose id is not held out and has a label.

    Rows of ``labels`` with a null id or a quality other than 0 and 1 are
    ignored; of several labels of one id the larger mean decides (1 on a tie);
    of several documents with one id the one with the smallest features counts.
    """
    known = (labels.where("quality IN (0, 1)").where(~held_out(F.col("doc_id"), folds)).groupBy("doc_id")
             .agg((F.avg("quality") >= 0.5).cast("double").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(_vectors(b)), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])
    rows = (by_bytes(docs).select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "y", "text")
            .mapInArrow(run, "doc_id long, y double, x array<double>")
            .groupBy("doc_id", "y").agg(F.min("x").alias("x")).collect())
    rows.sort(key=lambda r: r["doc_id"])
    return PairwiseGam().fit(np.array([r["x"] for r in rows], float).reshape(len(rows), len(FEATURES)), np.array([r["y"] for r in rows]))


def score(docs: DataFrame, model: PairwiseGam) -> DataFrame:
    """All columns of ``docs`` plus ``score``, which replaces one of that name.

    The score reads nothing but the whole text; null counts as empty. Rows are
    judged one by one, so repeated rows, null ids and other columns pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name != "score"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(b.schema.names.index(c)) for c in names] + [pa.array(shared.value.score(_vectors(b)))], names=[*names, "score"])
    return by_bytes(docs).mapInArrow(run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
