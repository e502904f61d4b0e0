"""Source divergence audit over a transducer vocabulary.

Terms that enough documents of a language hold are its vocabulary. From its
sorted terms a minimal acyclic transducer is built: an automaton whose equal
endings are one state and whose edges carry how many terms lie before them, so
that spelling a term sums up to its lexicographic ordinal. Texts then stream
through it, all tokens of a slice one byte further at a time; what it accepts is
counted by ordinal. Ordinals stand for terms in every later join and break ties,
and the transducers spell the few terms that are reported.
"""

from __future__ import annotations

import bisect
import collections
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import slices, small, store, table

LEAST, TOP, SCALE, PRIOR = 30, 50, 1_000_000_000, 5
#: Terms whose transducers are sent to every task, one a language; with more,
#: each holds at most SHARD terms and the terms come to it.
SENT, SHARD = 1_000_000, 50_000
#: Text bytes of a slice; entries that a task counts before it gives them on.
SLICE, ENTRIES = 2_000_000, 500_000
#: Sources and terms of one block of the pairwise sums.
SOURCES, TERMS = 64, 2048

#: ASCII letters, lower-cased, and all bytes beyond ASCII belong to terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ODD, _FREE = np.uint64(0x9E3779B97F4A7C15), np.uint64(2 ** 64 - 1)


class Transducer:
    """Edges (state, byte) -> (state, terms before) and final states."""

    def __init__(self, state: np.ndarray, byte: np.ndarray, child: np.ndarray, skip: np.ndarray, final: np.ndarray, root: int) -> None:
        self.state, self.byte, self.child, self.skip, self.final, self.root = state, byte, child, skip, final, root

    @classmethod
    def build(cls, terms: Iterator[bytes]) -> Transducer:
        """From distinct terms in byte order."""
        known: dict[tuple, int] = {}
        count: list[int] = []  # terms that can be spelled from a state
        path: list[list] = [[False, []]]  # states of the last term, still open
        last = b""

        def close() -> int:
            final, edges = path.pop()
            key = (final, tuple(edges))
            if key not in known:
                known[key] = len(known)
                count.append(final + sum(count[c] for _, c in edges))
            return known[key]

        def close_to(depth: int) -> None:
            while len(path) - 1 > depth:
                child = close()
                path[-1][1][-1] = (path[-1][1][-1][0], child)

        for term in terms:
            same = next((k for k, (x, y) in enumerate(zip(last, term, strict=False)) if x != y), min(len(last), len(term)))
            close_to(same)
            for b in term[same:]:
                path[-1][1].append((b, -1))
                path.append([False, []])
            path[-1][0] = True
            last = term
        close_to(0)
        root = close()
        rows = []
        for (final, edges), k in known.items():
            before = int(final)
            for b, c in edges:
                rows.append((k, b, c, before))
                before += count[c]
        state, byte, child, skip = (np.array(c, np.int64) for c in (zip(*rows, strict=True) if rows else [[]] * 4))
        return cls(state, byte, child, skip, np.array([f for f, _ in known], bool), root)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, state=self.state, byte=self.byte, child=self.child, skip=self.skip, final=self.final, root=self.root)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        with np.load(io.BytesIO(data)) as x:
            return cls(*(x[k] for k in ("state", "byte", "child", "skip", "final")), int(x["root"]))

    def index(self) -> None:
        """A hash table over the edges, at most half full."""
        n = max(1, len(self.state))
        bits = (2 * n - 1).bit_length()
        self._shift, self._mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self._keys = np.full(1 << bits, _FREE)
        self._child, self._skip = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
        keys = (self.state.astype(np.uint64) << np.uint64(8)) | self.byte.astype(np.uint64)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self._keys[slot[left]] == _FREE]
            _, one = np.unique(slot[free], return_index=True)
            put = free[one]
            at = slot[put]
            self._keys[at], self._child[at], self._skip[at] = keys[put], self.child[put], self.skip[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            slot[left] = (slot[left] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _ODD) >> self._shift).astype(np.int64)

    def ordinals(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Ordinal of each token data[start:start + size], -1 if it is none."""
        if not hasattr(self, "_keys"):
            self.index()
        out = np.full(len(starts), -1, np.int64)
        token, at, left = np.arange(len(starts)), starts.copy(), sizes.copy()
        state, place = np.full(len(starts), self.root, np.int64), np.zeros(len(starts), np.int64)
        while len(token):
            ended = left == 0
            if ended.any():
                hit = ended & self.final[state]
                out[token[hit]] = place[hit]
                on = ~ended
                token, at, left, state, place = token[on], at[on], left[on], state[on], place[on]
            key = (state.astype(np.uint64) << np.uint64(8)) | data[at].astype(np.uint64)
            slot = self._slot(key)
            held = self._keys[slot]
            wrong = np.flatnonzero((held != key) & (held != _FREE))
            while len(wrong):
                slot[wrong] = (slot[wrong] + 1) & self._mask
                held[wrong] = now = self._keys[slot[wrong]]
                wrong = wrong[(now != key[wrong]) & (now != _FREE)]
            on = held == key
            slot = slot[on]
            token, at, left, state, place = token[on], at[on] + 1, left[on] - 1, self._child[slot].astype(np.int64), place[on] + self._skip[slot]
        return out

    def terms(self) -> Iterator[bytes]:
        """All terms, by ordinal."""
        edges: dict[int, list] = collections.defaultdict(list)
        for s, b, c in zip(self.state.tolist(), self.byte.tolist(), self.child.tolist(), strict=True):
            edges[s].append((b, c))
        stack = [(self.root, b"")]
        while stack:
            state, term = stack.pop()
            if self.final[state]:
                yield term
            stack += [(c, term + bytes([b])) for b, c in sorted(edges[state], reverse=True)]


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' lower-cased bytes, each token's start and size, and its text."""
    data = np.frombuffer(b" ".join(texts).translate(LETTERS) + b" ", np.uint8)
    inside = np.append(False, data != 32)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    stops = np.cumsum([len(t) + 1 for t in texts])
    return data, starts, ends - starts, np.searchsorted(stops, starts, side="right")


def _clean(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _texts(b: pa.RecordBatch) -> Iterator[tuple[list[str], list[str], list[bytes]]]:
    lang, source, text = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()
    for i, j in slices([len(t) for t in text], SLICE):
        yield lang[i:j], source[i:j], text[i:j]


def _words(found: list[bytes]) -> pa.Array:
    return pa.array(found, pa.binary()).cast(pa.string())


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """lang, term of the terms that at least ``least`` of its documents hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, collections.Counter] = collections.defaultdict(collections.Counter)

        def given() -> Iterator[pa.RecordBatch]:
            for lang, c in seen.items():
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(c)), _words(list(c)), pa.array(c.values(), pa.int64())], names=["lang", "term", "n"])
            seen.clear()
        for b in batches:
            for langs, _, texts in _texts(b):
                for lang, t in zip(langs, texts, strict=True):
                    seen[lang].update(set(t.translate(LETTERS).split()))
                if sum(map(len, seen.values())) > ENTRIES:
                    yield from given()
        yield from given()
    counted = docs.select("lang", "source", "text").mapInArrow(run, "lang string, term string, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term")


def transducers(kept: DataFrame, limit: int | None) -> DataFrame:
    """shard, lang, first (its first ordinal), least (its first term), n, data.

    Without ``limit`` one a language, whose terms then go through one task:
    only for vocabularies of proven size. With it, the terms are cut by range.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, held = None, []

        def made() -> pa.RecordBatch:
            data = Transducer.build(iter(held)).to_bytes()
            return pa.RecordBatch.from_arrays([pa.array([lang]), _words(held[:1]), pa.array([len(held)], pa.int64()), pa.array([data], pa.binary())], names=["lang", "least", "n", "data"])
        for b in batches:
            for of, term in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if held and (of != lang or len(held) == limit):
                    yield made()
                    held.clear()
                lang = of
                held.append(term)
        if held:
            yield made()
    dealt = kept.repartitionByRange("lang", "term") if limit else kept.repartition("lang")
    rows = store(dealt.sortWithinPartitions("lang", "term").mapInArrow(run, "lang string, least string, n long, data binary"), "transducers")
    # a row a transducer: the order of their first terms is that of the ordinals
    listed = rows.select("lang", "least", "n").collect()
    first, at = [], collections.Counter()
    for k, r in enumerate(sorted(listed, key=lambda r: (r["lang"].encode(), r["least"].encode()))):
        first.append((k, r["lang"], r["least"], at[r["lang"]]))
        at[r["lang"]] += r["n"]
    places = rows.sparkSession.createDataFrame(first, "shard long, lang string, least string, first long")
    return rows.join(places, ["lang", "least"])


class _Counts:
    """Counts by (language, source) and ordinal, given on as batches."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.keys, self.sums, self.held = [], [], 0

    def add(self, group: np.ndarray, ordinal: np.ndarray, n: np.ndarray | None = None) -> None:
        key = (group.astype(np.int64) << 40) | ordinal
        found, at = np.unique(key, return_inverse=True)
        self.keys.append(found)
        self.sums.append(np.bincount(at, n, len(found)).astype(np.int64))
        self.held += len(found)

    def group(self, lang: str, source: str) -> int:
        return self.groups.setdefault((lang, source), len(self.groups))

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            found, at = np.unique(np.concatenate(self.keys), return_inverse=True)
            n = np.bincount(at, np.concatenate(self.sums), len(found)).astype(np.int64)
            g, names = pa.array(found >> 40), list(self.groups)
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in names]).take(g), pa.array([b for _, b in names]).take(g), pa.array(found & ((1 << 40) - 1)), pa.array(n)],
                                             names=["lang", "source", "ordinal", "n"])
        self.__init__()


COUNTS = "lang string, source string, ordinal long, n long"


def _recount_sent(docs: DataFrame, held: DataFrame) -> DataFrame:
    """Texts stream through transducers that every task has."""
    shared = docs.sparkSession.sparkContext.broadcast({r["lang"]: bytes(r["data"]) for r in held.select("lang", "data").collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[str, Transducer] = {}
        counts = _Counts()
        for b in batches:
            for langs, sources, texts in _texts(b):
                data, starts, sizes, doc = tokens(texts)
                of = np.array(langs, object)
                group = np.array([counts.group(*x) for x in zip(langs, sources, strict=True)], np.int64)
                for lang in set(langs) & shared.value.keys():
                    if lang not in ready:
                        ready[lang] = Transducer.from_bytes(shared.value[lang])
                    mine = np.flatnonzero((of == lang)[doc])
                    ordinal = ready[lang].ordinals(data, starts[mine], sizes[mine])
                    hit = ordinal >= 0
                    counts.add(group[doc[mine[hit]]], ordinal[hit])
                if counts.held > ENTRIES:
                    yield from counts.batches()
        yield from counts.batches()
    return docs.mapInArrow(run, COUNTS)


def _recount_dealt(docs: DataFrame, held: DataFrame) -> DataFrame:
    """Each task's distinct terms and counts go to the transducer whose range
    they lie in; only the ranges' first terms are sent to all tasks."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(sorted((r["lang"].encode(), r["least"].encode(), r["shard"]) for r in held.select("lang", "least", "shard").collect()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = [e[:2] for e in shared.value]
        seen: collections.Counter = collections.Counter()

        def given() -> Iterator[pa.RecordBatch]:
            rows = []
            for (lang, source, term), n in seen.items():
                k = bisect.bisect_right(edges, (lang.encode(), term)) - 1
                if k >= 0 and edges[k][0] == lang.encode():
                    rows.append((shared.value[k][2], lang, source, term, n))
            seen.clear()
            if rows:
                shard, lang, source, term, n = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(lang), pa.array(source), _words(list(term)), pa.array(n, pa.int64())], names=["shard", "lang", "source", "term", "n"])
        for b in batches:
            for langs, sources, texts in _texts(b):
                for lang, source, t in zip(langs, sources, texts, strict=True):
                    for term, n in collections.Counter(t.translate(LETTERS).split()).items():
                        seen[lang, source, term] += n
                if len(seen) > ENTRIES:
                    yield from given()
        yield from given()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, spells, first = _Counts(), None, 0
        for b in batches:
            shard, base, data, lang, source, term, n = (c.to_pylist() for c in b.columns)
            heads = [k for k, x in enumerate(data) if x is not None]
            for i, j in zip([0, *heads], [*heads, len(data)], strict=True):
                if i < j and data[i] is not None:
                    spells, first = Transducer.from_bytes(data[i]), base[i]
                    i += 1
                if i < j:
                    bytes_, starts, sizes, _ = tokens([t.encode() for t in term[i:j]])
                    ordinal = spells.ordinals(bytes_, starts, sizes)
                    hit = np.flatnonzero(ordinal >= 0)
                    group = np.array([counts.group(lang[i + k], source[i + k]) for k in hit.tolist()], np.int64)
                    counts.add(group, ordinal[hit] + first, np.array(n[i:j])[hit])
            if counts.held > ENTRIES:
                yield from counts.batches()
        yield from counts.batches()

    asked = docs.mapInArrow(deal, "shard long, lang string, source string, term string, n long").groupBy("shard", "lang", "source", "term").agg(F.sum("n").alias("n"))
    both = held.select("shard", "first", "data").unionByName(asked, allowMissingColumns=True)
    return (both.repartition("shard").sortWithinPartitions("shard", F.col("data").isNull())
            .select("shard", "first", "data", "lang", "source", "term", "n").mapInArrow(run, COUNTS))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exact."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = F.lit(SCALE).cast("decimal(10,0)") * (wide(count) + F.lit(PRIOR).cast("decimal(1,0)"))
    below = wide(total) + wide(F.lit(PRIOR) * terms)
    return F.when(below > 0, F.call_function("div", top, below) + 1)


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, i, j, value for i < j: sums of |p - q| over all kept terms.

    Blocks of terms and of sources are summed one by one; a source's terms
    without a row count with its share of nothing.
    """
    block = F.floor(F.col("idx") / SOURCES)
    last = F.greatest(F.lit(0), F.ceil(F.col("terms") / TERMS) - 1).cast("long")
    seeds = groups.select("lang", "idx", "n_sources", "terms", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part"), F.lit(-1).cast("long").alias("ordinal"), F.coalesce("nothing", F.lit(0)).cast("long").alias("p"))
    rows = shares.select("lang", "idx", "n_sources", "terms", F.floor(F.col("ordinal") / TERMS).alias("part"), F.col("ordinal") % TERMS, "p").toDF(*seeds.columns).unionByName(seeds)
    others = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_sources") - 1) / SOURCES))
    rows = rows.withColumn("own", block).withColumn("other", F.explode(others))
    rows = rows.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lang, part, a, b = key
        seed = pdf["ordinal"].to_numpy() < 0
        names = np.unique(pdf["idx"].to_numpy()[seed])
        size = int(min(TERMS, pdf["terms"].iloc[0] - part * TERMS))
        at = np.searchsorted(names, pdf["idx"].to_numpy())
        p = np.zeros((len(names), max(0, size)), np.int64)
        values = pdf["p"].to_numpy(np.int64)
        p[at[seed]] = values[seed, None]
        p[at[~seed], pdf["ordinal"].to_numpy()[~seed]] = values[~seed]
        out = []
        for k in np.flatnonzero(names // SOURCES == a):
            far = np.flatnonzero((names // SOURCES == b) & (names > names[k]))
            out.append(pd.DataFrame({"lang": lang, "i": names[k], "j": names[far], "value": np.abs(p[far] - p[k]).sum(1)}))
        return pd.concat(out) if out else pd.DataFrame({"lang": [], "i": [], "j": [], "value": []})
    sums = rows.groupBy("lang", "part", "a", "b").applyInPandas(run, "lang string, i long, j long, value long")
    return sums.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least: int = LEAST, top: int = TOP, sent: int = SENT, shard: int = SHARD) -> DataFrame:
    """lang, source, part, item, value, rank: see the module's words.

    Part ``pair`` ranks the other sources of a group's language by the summed
    differences of their shares, part ``term`` the ``top`` terms whose share in
    the group exceeds the language's. Null text, lang and source are empty
    strings; documents without terms still make their group; repeated rows are
    documents of their own; other columns are ignored. A language without kept
    terms has pairs of value 0, one with a single source no pair. An empty table
    has no rows.
    """
    docs = _clean(docs)
    kept = store(kept_terms(docs, least), "kept")
    whole = kept.limit(sent + 1).count() <= sent
    held = store(transducers(kept, None if whole else shard), "vocabulary")
    counts = (_recount_sent if whole else _recount_dealt)(docs, held).groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))
    counts = store(counts, "counts")

    terms = held.groupBy("lang").agg(F.sum("n").alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    order = Window.partitionBy("lang").orderBy("source")
    groups = (docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(terms, "lang", "left")
              .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"))
              .withColumn("idx", (F.row_number().over(order) - 1).cast("long"))
              .withColumn("n_sources", F.count(F.lit(1)).over(Window.partitionBy("lang")))
              .withColumn("nothing", _share(F.lit(0), F.col("total"), F.col("terms"))))
    groups = store(groups, "groups")
    shares = counts.join(small(groups), ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))

    found = store(_pairs(shares, groups), "pairs")
    names = lambda k: groups.select("lang", F.col("idx").alias(k), F.col("source").alias(f"source_{k}"))
    both = found.join(small(names("i")), ["lang", "i"]).join(small(names("j")), ["lang", "j"])
    sides = F.explode(F.array(*[F.struct(F.col(f"source_{x}").alias("source"), F.col(f"source_{y}").alias("item")) for x, y in ("ij", "ji")])).alias("s")
    pair = both.select("lang", sides, "value").select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    pair = pair.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

    of_lang = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n"))
    whole_of = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms"))
    q = of_lang.join(small(whole_of), "lang").select("lang", "ordinal", _share(F.col("n"), F.col("total"), F.col("terms")).alias("q"))
    over = shares.join(q, ["lang", "ordinal"]).where("p > q").select("lang", "source", "ordinal", (F.col("p") - F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    reported = store(over.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top), "reported")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, first, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = list(Transducer.from_bytes(data).terms())
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(found)), pa.array(np.arange(first, first + len(found))), _words(found)], names=["lang", "ordinal", "item"])
    wanted = reported.select("lang", "ordinal").distinct()
    spelled = held.select("lang", "first", "data").mapInArrow(spell, "lang string, ordinal long, item string").join(small(wanted), ["lang", "ordinal"], "left_semi")
    term = reported.join(small(store(spelled, "spelled")), ["lang", "ordinal"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pair.unionByName(term)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents", "lang", "source", "text"))


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT id) >= {LEAST}),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY ALL),
g AS (SELECT d.lang, d.source, any_value(coalesce(v.v, 0)) AS v FROM d LEFT JOIN v USING (lang) GROUP BY ALL),
gn AS (SELECT g.lang, g.source, g.v, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n,
    CAST(1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + {PRIOR})) // (gn.total + {PRIOR} * gn.v) AS BIGINT) AS p
  FROM gn JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
ln AS (SELECT lang, sum(n) AS total, any_value(v) AS v FROM c JOIN v USING (lang) GROUP BY lang),
q AS (SELECT c.lang, c.term, CAST(1 + ({SCALE}::HUGEINT * (sum(c.n) + {PRIOR})) // any_value(ln.total + {PRIOR} * ln.v) AS BIGINT) AS q
  FROM c JOIN ln USING (lang) GROUP BY c.lang, c.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r
QUALIFY part = 'pair' OR rank <= {TOP}
"""
