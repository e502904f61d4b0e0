"""Tables and plain versions that the operators are held against."""

from __future__ import annotations

import collections
import os
import zlib

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def remainder(doc_id, mod):
    return zlib.crc32(str(doc_id).encode()) % mod


def save(spark, folder, **tables):
    """Write tables as the registered queries read them."""
    for name, df in tables.items():
        df.write.parquet(os.path.join(folder, f"{name}.parquet"))
    return str(folder)


def awkward(spark):
    """Null and repeated ids, null, empty and very long texts, repeated rows,
    and a column named like an output."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [(1, "one two three four five six", "a"), (1, "one two three four five six", "a"), (1, "another text under the same id", "b"),
            (None, "one two three four five six", "c"), (None, None, None), (2, None, "d"), (3, "", "e"), (4, " \n\t\n ", "f"),
            (5, long, "g"), (6, long + " more", "h"), (7, "É é ß 日本語 \u0000 x", "i"), (8, "a" * 50_000, "j")]
    return spark.createDataFrame([(i, t, s, 9.0, 7) for i, t, s in rows], "doc_id long, text string, source string, score double, n_hit int")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


class Groups:
    """Union of ids under their smallest."""

    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def near_groups(rows, size, similar=80):
    """id -> smallest id linked, over (id, text) with distinct ids."""
    sets, g = {i: shingles(t, size) for i, t in rows}, Groups([i for i, _ in rows])
    by_word = collections.defaultdict(list)
    for i, s in sets.items():
        met = collections.Counter(j for x in s for j in by_word[x])
        for j, both in met.items():
            if 100 * both >= similar * (len(s) + len(sets[j]) - both):
                g.link(i, j)
        for x in s:
            by_word[x].append(i)
    return {i: g.find(i) for i, _ in rows}, sets
