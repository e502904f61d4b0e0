"""Divergence audit: the transducer, and the whole against plain counting."""

import collections
import random
import re

import numpy as np
import pytest

from llm import divergence as dv
from tests.llm.helpers import awkward, rows_of

DOCS = "doc_id long, text string, lang string, source string"


def random_terms(rng, n):
    return sorted({"".join(rng.choice(["a", "b", "ba", "é", "ß日", "z"]) for _ in range(rng.randrange(1, 7))).encode() for _ in range(n)})


def test_transducer_spells_ordinals():
    rng = random.Random(3)
    for n in (0, 1, 2, 40, 700):
        terms = random_terms(rng, n)
        t = dv.Transducer.from_bytes(dv.Transducer.build(iter(terms)).to_bytes())
        assert list(t.terms()) == terms
        asked = terms + [b"a" * 50, b"zzzzzzzzz", "日".encode()] + random_terms(rng, 60)
        data, starts, sizes, _ = dv.tokens([b" ".join(asked)])
        place = {x: k for k, x in enumerate(terms)}
        assert t.ordinals(data, starts, sizes).tolist() == [place.get(x, -1) for x in asked]


def test_transducer_is_minimal():
    terms = random_terms(random.Random(9), 300)
    t = dv.Transducer.build(iter(terms))
    edges = collections.defaultdict(set)
    for s, b, c in zip(t.state.tolist(), t.byte.tolist(), t.child.tolist(), strict=True):
        edges[s].add((b, c))

    def endings(prefix):  # what may follow a prefix: one state each
        return frozenset(x[len(prefix):] for x in terms if x.startswith(prefix))
    prefixes = {x[:k] for x in terms for k in range(len(x) + 1)}
    assert len(t.final) == len({endings(p) for p in prefixes})
    assert len({(bool(t.final[s]), frozenset(edges[s])) for s in range(len(t.final))}) == len(t.final)


def test_tokens_of_texts():
    texts = ["Ab cD", "", "x1y", " \u0085é　ß ", "İ-K\x7fq"]
    data, starts, sizes, doc = dv.tokens([t.encode() for t in texts])
    got = [(d, bytes(data[s:s + n]).decode()) for s, n, d in zip(starts, sizes, doc, strict=True)]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert got == [(k, w.translate(lower)) for k, t in enumerate(texts) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)]


def plain(rows, least, top):
    """(lang, source, part, item, value, rank) by direct counting."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))) for text, lang, source in rows]
    out = []
    for lang in {x for x, _, _ in words}:
        mine = [(s, w) for x, s, w in words if x == lang]
        df = collections.Counter(t for _, w in mine for t in set(w))
        kept = sorted((t for t, n in df.items() if n >= least), key=str.encode)
        count = collections.defaultdict(collections.Counter)
        for s, w in mine:
            count[s].update(t for t in w if df[t] >= least)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in count.items()}, share(sum(count.values(), collections.Counter()))
        for s in p:
            pair = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in p if o != s))
            term = sorted((-(p[s][t] - q[t]), t.encode(), t) for t in kept if count[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, x, -v, k) for part, found in (("pair", pair), ("term", term)) for k, (v, _, x) in enumerate(found, 1)]
    return sorted(out)


def corpus():
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "élan", "ß", "日本", "x", "yy", "zzz", "d1e"] + ["".join(rng.choice("abcdefg") for _ in range(3)) for _ in range(60)]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(0, 40))), rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "b", "c", None, "d"])) for _ in range(300)]
    return rows + [(None, "en", "void"), ("", "fr", "one"), ("rare", "it", "one"), (None, "it", "two"), (" ".join(words) * 400, "en", "long")] + [("same text", "en", "copies")] * 9


@pytest.mark.parametrize(("sent", "shard", "blocks"), [(10**6, 50, (64, 2048)), (0, 7, (2, 5)), (0, 50, (64, 2048))])
def test_divergence_equals_plain_counting(spark, monkeypatch, sent, shard, blocks):
    monkeypatch.setattr(dv, "SOURCES", blocks[0])
    monkeypatch.setattr(dv, "TERMS", blocks[1])
    rows = corpus()
    docs = spark.createDataFrame([(k, *r, 1, "x") for k, r in enumerate(rows)], DOCS + ", n int, term string").repartition(5)
    got = rows_of(dv.divergence(docs, least=4, top=6, sent=sent, shard=shard))
    assert sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in got) == plain(rows, 4, 6)


def test_shares_are_exact_for_huge_counts(spark):
    n, total, terms = 7_777_777_777_777_777, 9_000_000_000_000_000_001, 123_456_789
    got = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long").select(dv._share(*map(dv.F.col, ("n", "total", "terms"))).alias("p")).first()[0]
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * terms)


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark).withColumn("lang", dv.F.when(dv.F.col("doc_id") > 2, "en")).withColumn("source", dv.F.col("doc_id").cast("string"))
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    got = rows_of(dv.divergence(docs, least=2))
    assert sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in got) == plain(rows, 2, 50)
    assert rows_of(dv.divergence(docs.limit(0))) == [] and np.size(dv.tokens([])[1]) == 0
