"""Operators that judge texts one by one: quality, licences, benchmark."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import decontaminate, license_scan, quality
from tests.llm.helpers import awkward, empty, remainder, rows_of

RNG = random.Random(5)
WORDS = ["the", "of", "rain", "stone", "river", "cloud", "under", "bright", "seven", "walk"]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def judged(spark):
    rng, rows = random.Random(1), []
    for i in range(600):
        good = rng.random() < 0.7
        text = prose(rng.randrange(20, 80), rng)
        rows.append((i, text if good else rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", "$$$ "), "buy " * 60]), int(good)))
    return rows


def test_quality_learns_from_text_and_holds_out(spark, judged):
    docs = spark.createDataFrame([(i, t) for i, t, _ in judged], "doc_id long, text string")
    # wrong labels on held-out rows must not matter
    labels = [(i, q if remainder(i, 5) else 1 - q) for i, _, q in judged] + [(None, 1), (3, None), (4, 7)]
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = {r["doc_id"]: r["score"] for r in rows_of(quality.score(docs, model))}
    assert all(0 <= s <= 1 for s in got.values())
    held = [(got[i] >= quality.THRESHOLD) == bool(q) for i, _, q in judged if remainder(i, 5) == 0]
    assert len(held) > 60 and np.mean(held) > 0.95


def test_quality_score_is_a_sum_of_tables():
    rng = np.random.default_rng(0)
    x = rng.random((500, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # only the pair tells
    m = quality.PairwiseGam(rounds=20, pairs=2, pair_rounds=40).fit(x, y)
    assert (1, 0) in m.pairs and ((m.score(x) >= 0.5) == y).mean() > 0.9
    b = m.binned(x[:1])[0]
    raw = m.base + sum(t[k] for t, k in zip(m.tables, b, strict=True)) + sum(t[b[i] * m.bins + b[j]] for (i, j), t in zip(m.pairs, m.pair_tables, strict=True))
    assert abs(m.score(x[:1])[0] - 1 / (1 + np.exp(-raw))) < 1e-12


def test_quality_of_awkward_rows_and_without_labels(spark):
    docs = awkward(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = rows_of(quality.score(docs, quality.train(docs, none)))
    assert len(got) == docs.count() and {r["score"] for r in got} == {0.5} and all(r["n_hit"] == 7 for r in got)
    one = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (2, 0)], "doc_id long, quality int")
    assert all(0 < r["score"] < 1 for r in rows_of(quality.score(docs, quality.train(docs, one))))
    assert quality.score(empty(spark), quality.train(empty(spark), one)).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""


@pytest.mark.parametrize("text, licenses, left", [
    (MIT, "MIT", 0),
    (MIT.split("\n\n")[0], "MIT", 0),
    ("prose without an end\nReleased under the MIT License.\nmore", "MIT", 0),
    ("// SPDX-License-Identifier: Apache-2.0\ncode", "Apache-2.0", 0),
    ("Licensed under the Apache Licence, Version 2.0. All rights reserved.", "Apache-2.0", 1),
    ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "", 1),
    ("The word license alone is none.", "", 0),
])
def test_license_rules(spark, text, licenses, left):
    got = rows_of(license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")))[0]
    assert (got["licenses"], got["n_left"]) == (licenses, left)


def test_known_sentences_are_normal_and_have_a_trigger(spark):
    rows = spark.createDataFrame([(s,) for s in license_scan.SENTENCES], "s string")
    assert rows.where(license_scan.normal(F.col("s")) != F.col("s")).count() == 0
    assert all(re.search(license_scan.TRIGGERS, s) for s in license_scan.SENTENCES)


def test_license_scan_of_awkward_rows(spark):
    docs = awkward(spark)
    got = rows_of(license_scan.scan(docs))
    assert len(got) == docs.count() and all(r["licenses"] == "" and r["n_known"] == 0 for r in got)
    assert license_scan.scan(empty(spark)).count() == 0


def brute_hits(text, items, size=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = split(text), set(), set()
    for item, t in items:
        w = split(t)
        for win in {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else ():
            for i in range(len(words) - len(win) + 1):
                if tuple(words[i:i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def test_decontamination_against_brute_force(spark):
    rng = random.Random(9)
    items = [(k, prose(rng.randrange(1, 30), rng)) for k in range(12)] + [(3, "The. RAIN"), (50, None), (51, ""), (52, "é-é Walk"), (None, "stone cloud seven")]
    docs = []
    for i in range(40):
        t = prose(rng.randrange(0, 60), rng)
        if i % 3 == 0:
            t += "; " + (rng.choice(items)[1] or "").upper() + " " + prose(5, rng)
        docs.append((i, t))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {i: brute_hits(t, [("null" if k is None else k, x) for k, x in items]) for i, t in docs}
    for block in (10_000, 40):  # one index, and several blocks
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows_of(decontaminate.decontaminate(df, bench, block=block))}
        assert got == want


def test_decontamination_of_awkward_rows(spark):
    docs = awkward(spark)
    bench = spark.createDataFrame([(1, "three four five")], "item_id long, text string")
    got = rows_of(decontaminate.decontaminate(docs, bench))
    assert len(got) == docs.count() and sum(r["n_hit"] for r in got) == 9 and all(r["score"] == 9.0 for r in got)
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r["n_hit"] == 0 for r in rows_of(decontaminate.decontaminate(docs, none)))
    assert decontaminate.decontaminate(empty(spark), bench).count() == 0


def test_registered_digest_of_no_items(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.array_join(F.array().cast("array<string>"), ",").cast("binary"), 256)).first()[0]
