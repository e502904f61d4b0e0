"""Operators on pairs: line deduplication, near duplicates, top-k search."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import line_dedup, near_duplicates, top_k
from tests.llm.helpers import Groups, awkward, empty, near_groups, rows_of


def edited(text, times, rng, letters="abcd"):
    s = list(text)
    for _ in range(times):
        i, what = rng.randrange(len(s) + 1), rng.randrange(3)
        if what == 0:
            s.insert(i, rng.choice(letters))
        elif s and what == 1:
            del s[min(i, len(s) - 1)]
        elif s:
            s[min(i, len(s) - 1)] = rng.choice(letters)
    return "".join(s)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance(spark):
    rng = random.Random(2)
    base = ["".join(rng.choice("abé") for _ in range(rng.randrange(1, 40))) for _ in range(150)]
    pairs = [(b, e) for b in base for e in (edited(b, rng.randrange(5), rng),) if e] + [("b", "acc"), ("a", "a")]
    pairs += [(x * 30, edited(x * 30, rng.randrange(4), rng)) for x in ("abcdefg", "aab", "é")] + [("", "a"), ("", "ab"), ("abc" * 20, "abc" * 20 + "d")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for errors in (1, 2):
        lines = df.select(F.monotonically_increasing_id().alias("a"), F.lit(0).alias("b"), F.col("a").alias("line_a"), F.col("b").alias("line_b"))
        want = [r["a"] for r in lines.collect() if distance(r["line_a"], r["line_b"]) <= errors]
        assert sorted(r["a"] for r in line_dedup.verified(lines, errors).collect()) == want
    for errors in (1, 2, 3):
        got = df.select(line_dedup.within(F.col("a"), F.col("b"), errors)).collect()
        assert [r[0] for r in got] == [distance(a, b) <= errors for a, b in pairs]


@pytest.mark.parametrize("errors, crowd", [(1, 32), (1, 2), (2, 3)])
def test_candidates_miss_no_pair(spark, errors, crowd):
    rng = random.Random(errors)
    base = ["".join(rng.choice("abc") for _ in range(rng.randrange(8, 30))) for _ in range(12)]
    texts = sorted({edited(rng.choice(base), rng.randrange(4), rng, "abc") for _ in range(150)})
    df = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    got = {(r["a"], r["b"]) for r in line_dedup.candidates(df, errors, crowd).collect()}
    assert not {(i, j) for i, x in enumerate(texts) for j, y in enumerate(texts) if i < j and distance(x, y) <= errors} - got


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(5, 40))) for _ in range(20)]
    docs = [(i, "\n".join(edited(rng.choice(base), rng.randrange(2), rng) for _ in range(rng.randrange(1, 6)))) for i in range(30)]
    shortest = 10
    first, n_before = {}, {}
    for i, t in docs:
        for p, line in enumerate(t.split("\n")):
            if len(line) >= shortest:
                first.setdefault(line, (i, p))
    lines = sorted(first, key=first.get)
    g = Groups(range(len(lines)))
    links = [0] * len(lines)
    for i, x in enumerate(lines):
        for j in range(i):
            if distance(x, lines[j]) <= 1:
                g.link(i, j)
                links[i] += 1
                links[j] += 1
    at = {x: i for i, x in enumerate(lines)}
    want = {}
    for i, t in docs:
        kept, gone, near, linked = [], 0, 0, 0
        for p, line in enumerate(t.split("\n")):
            if line not in at:
                kept.append(line)
                continue
            linked += links[at[line]]
            if first[lines[g.find(at[line])]] == (i, p):
                kept.append(line)
            else:
                gone += 1
                near += first[line] == (i, p)
        want[i] = ("\n".join(kept), gone, near, linked)
    got = rows_of(line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), shortest=shortest))
    assert {r["doc_id"]: (r["text"], r["n_repeated"], r["n_near"], r["n_links"]) for r in got} == want


def test_line_dedup_of_awkward_rows(spark):
    docs = awkward(spark)
    got = rows_of(line_dedup.dedup_lines(docs))
    assert len(got) == docs.count()
    by = {(r["doc_id"], r["source"]): r for r in got}
    assert by[1, "b"]["text"] == "another text under the same id" and by[2, "d"]["text"] is None and by[2, "d"]["n_lines"] == 0
    assert by[1, "a"]["text"] == "" and by[None, "c"]["text"] == "one two three four five six"  # a null id comes first
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def copies(rng, n_words, n, edits, words):
    base = [rng.choice(words) for _ in range(n_words)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = rng.choice(words)
        yield " ".join(w)


@pytest.fixture(scope="module")
def near_docs():
    rng, words = random.Random(4), [f"w{i}" for i in range(400)]
    texts = [t for n, m, e in ((60, 40, 8), (60, 5, 1), (12, 8, 1), (5, 6, 1), (300, 6, 12)) for t in copies(rng, n, m, e, words)]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 50))) for _ in range(60)] + ["a b", "A  b", "a b c", "", " "]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_against_brute_force(spark, near_docs, size):
    groups, sets = near_groups(near_docs, size)
    got = rows_of(near_duplicates.near_duplicates(spark.createDataFrame(near_docs, "doc_id long, text string"), size))
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"], r["kept"]) for r in got} == {i: (g, len(sets[i]), g == i) for i, g in groups.items()}


def test_group_of_near_copies_against_brute_force(spark):
    """Copies of one text with edits of their own: most pairs share band keys
    and are not similar; what links is found on the full sets."""
    rng = random.Random(17)
    base = [f"w{k}" for k in range(150)]
    docs = []
    for i in range(260):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.randrange(0, 14)):
            words[at] = f"x{rng.random()}"
        docs.append((i, " ".join(words[:rng.choice([150, 150, 147, 120])])))
    want, sets = near_groups(docs, 4)
    assert 2 < len(set(want.values())) < len(docs) - 50
    got = rows_of(near_duplicates.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_sets_that_share_a_node_number_stay_apart(spark, near_docs):
    want, sets = near_groups(near_docs, 4)
    got = rows_of(near_duplicates.near_duplicates(spark.createDataFrame(near_docs, "doc_id long, text string"), bits=5))
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in got} == {i: (want[i], len(sets[i])) for i, _ in near_docs}


def test_register_estimate_is_close():
    rng = np.random.default_rng(0)
    for share in (0.5, 0.8, 0.95):
        a = np.unique(rng.integers(0, 2 ** 63, 4000, dtype=np.uint64) * np.uint64(2))
        k = int(len(a) * 2 * share / (1 + share))
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[:k]], rng.integers(0, 2 ** 63, len(a) - k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]))
        n = np.array([4000.0])
        c = near_duplicates.chance(n, n)[0]
        guess = ((near_duplicates.registers(a) == near_duplicates.registers(b)).mean() - c) / (1 - c)
        assert 0 < c < 0.001 and abs(guess - share) < 0.15


def test_near_duplicates_of_awkward_rows(spark):
    docs = awkward(spark)
    got = rows_of(near_duplicates.near_duplicates(docs))
    assert len(got) == docs.count()
    same = [r for r in got if r["n_shingles"] == 3 and r["component_id"] == 1]
    assert len(same) == 4  # the repeated row, the other text of that id, the row without an id
    assert [r["kept"] for r in got if r["doc_id"] is None and r["n_shingles"] == 3] == [False]
    assert all(r["kept"] and r["component_id"] == r["doc_id"] for r in got if r["n_shingles"] == 0 and r["doc_id"] is not None)
    assert near_duplicates.near_duplicates(empty(spark)).count() == 0


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-3, 4, (400, 6)).astype(float) / 64  # many ties and equal vectors
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(900, None), (None, [1.0] * 6), (901, [None] + [0.0] * 5), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (5, rows[5][1]), (904, [0.05])]
    df = top_k.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = {}
    for r in rows_of(top_k.top_k(df, df.where("vec_id % 20 = 0"), 7)):
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    v = np.floor(64 * x.astype(np.float32).astype(float))
    points = [(i, v[i]) for i in range(400)] + [(904, np.array([3.0, 0, 0, 0, 0, 0]))]
    for q in range(0, 400, 20):
        best = sorted((-int(v[q] @ p), i) for i, p in points if i != q)[:7]
        assert sorted(got[q]) == [(k + 1, -s, i) for k, (s, i) in enumerate(best)]
    assert set(got) == set(range(0, 400, 20))


def test_top_k_of_few_and_large_vectors(spark):
    few = top_k.integer_vectors(spark.createDataFrame([(0, [1.0, 2.0]), (1, [3e38, 1.0])], "vec_id long, embedding array<float>"))
    got = rows_of(top_k.top_k(few, few.where("vec_id = 0")))
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 1, 2 ** 63 - 1)]
    none = few.limit(0)
    assert top_k.top_k(none, none).count() == 0


def test_m_tree_prunes_nothing_that_counts():
    rng = np.random.default_rng(2)
    p, q = rng.normal(size=(2000, 5)), rng.normal(size=(40, 5))
    tree, seen, best, bound = top_k.MTree(p), [], [[] for _ in q], np.full(len(q), np.inf)

    def found(entries, live):
        seen.append(len(entries) * len(live))
        for i in live:
            best[i] = sorted(best[i] + np.sqrt(((p[entries] - q[i]) ** 2).sum(1)).tolist())[:10]
            bound[i] = best[i][-1] if len(best[i]) == 10 else np.inf
    tree.search(q, bound, found, 1e-9)
    for i, x in enumerate(q):
        assert np.allclose(best[i], np.sort(np.sqrt(((p - x) ** 2).sum(1)))[:10])
    assert sum(seen) < len(p) * len(q)


def test_best_scores_of_a_block_keep_ties_by_id():
    rng = random.Random(4)
    queries, rows = np.array([7, 7, 100]), [(rng.randrange(6), i) for i in range(90)]
    best = top_k._Best(queries, np.array([-np.inf, 2.0, -np.inf]), 8)
    for i in range(0, 90, 30):
        part = rows[i:i + 30]
        best.add(np.arange(3), np.array([[s for s, _ in part]] * 3, float), np.array([v for _, v in part]))
    for row, query in enumerate(queries):
        want = sorted(((-s, v) for s, v in rows if v != query and (row != 1 or s >= 2)))[:8]
        assert sorted((-s, v) for a, s, v in zip(best.at, best.scores, best.ids, strict=True) if a == row) == want
