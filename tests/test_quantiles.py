"""Sort-and-rank exact quantiles equal the built-in percentile."""

import random

from pyspark.sql import functions as F

from tidepool.operators.quantiles import exact_quantiles


def test_equals_builtin_percentile_with_hot_group(spark):
    rnd = random.Random(5)
    rows = []
    for g in range(6):
        n = 3000 if g == 0 else rnd.randint(1, 40)          # group 0 is hot
        for _ in range(n):
            v = None if rnd.random() < 0.05 else float(rnd.choice([rnd.randint(0, 20), rnd.random() * 100]))
            w = None if rnd.random() < 0.3 else rnd.randint(-5, 5)
            rows.append((g % 3, str(g), v, w))
    rows.append((9, "z", None, None))                          # group with no values
    df = spark.createDataFrame(rows, "a int, b string, v double, w long").repartition(7)
    q = {"v50": ("v", 0.5), "v25": ("v", 0.25), "v75": ("v", 0.75), "w50": ("w", 0.5), "w90": ("w", 0.9)}
    got = exact_quantiles(df, ["a", "b"], {"v": F.col("v"), "w": F.col("w")}, q)
    want = df.groupBy("a", "b").agg(*[F.percentile(m, p).alias(k) for k, (m, p) in q.items()])
    g = {(r["a"], r["b"]): r for r in got.collect()}
    for r in want.collect():
        key = (r["a"], r["b"])
        for k in q:
            if r[k] is None:
                assert key not in g or g[key][k] is None
            else:
                assert g[key][k] == r[k], (key, k, g[key][k], r[k])


def test_null_group_keys_and_one_hot_value(spark):
    rows = [("d", None, v) for v in (1.0, 2.0, 3.0, None)] + [("d", "p", 7.0)] * 500 + [("d", "p", 1.0)]
    df = spark.createDataFrame(rows, "day string, pool string, v double").repartition(5)
    got = {r["pool"]: r["m"] for r in exact_quantiles(df, ["day", "pool"], {"v": F.col("v")}, {"m": ("v", 0.5)}).collect()}
    assert got == {None: 2.0, "p": 7.0}


def test_positions_of_a_hot_group(spark):
    from tidepool.operators.quantiles import positions
    rows = [("hot" if k % 3 else None if k % 2 else f"g{k % 7}", (k * 7919) % 5003, k) for k in range(5003)]
    df = spark.createDataFrame(rows, "g string, o long, v long").repartition(6)
    got = positions(df, ["g"], "o").collect()
    by = {}
    for g, o, v in rows:
        by.setdefault(g, []).append(o)
    place = {(g, o): k for g, os in by.items() for k, o in enumerate(sorted(os))}
    assert len(got) == len(rows) and all(r["pos"] == place[r["g"], r["o"]] for r in got)


def test_fingerprints_and_differences(spark):
    from tidepool.operators import checks
    a = [(1, "x", None), (1, "x", None), (2, "y", 1), (3, None, 2), (None, "z", 3), (4, "only", 4)]
    b = [(1, "x", None), (2, "y", 1), (3, 2, None), (None, "z", 3), (5, "new", 5)]
    kind = "period int, t string, n int"
    left, right = spark.createDataFrame(a, kind), spark.createDataFrame([(p, None if t == 2 else t, n) for p, t, n in b], kind)
    same = {r["period"]: (r["benchmarkRows"], r["challengerRows"], r["identical"]) for r in checks.fingerprints(left, right, "period").collect()}
    assert same == {1: (2, 1, "false"), 2: (1, 1, "true"), 3: (1, 1, "false"), None: (1, 1, "true"), 4: (1, 0, "false"), 5: (0, 1, "false")}
    found = sorted(map(tuple, checks.differences(left, right, "period").collect()), key=str)
    assert found == sorted([(1, "x", None, 2, 1), (3, None, 2, 1, 0), (3, None, None, 0, 1), (4, "only", 4, 1, 0), (5, "new", 5, 0, 1)], key=str)
    rep = {r["period"]: (r["benchmarkRows"], r["challengerRows"], r["distinctRows"], r["identical"]) for r in checks.reconcile(left, right, "period").collect()}
    assert rep[1] == (2, 1, 1, "false") and rep[2] == (1, 1, 1, "true") and rep[4] == (1, None, 1, "false") and rep[None] == (1, 1, 1, "true")


def test_quartile_numbers():
    import pytest

    from tidepool.operators.daily import QUANTILES, quartile
    assert [QUANTILES[f"tipQ{k}"] for k in (1, 2, 3)] == [("tip", 0.25), ("tip", 0.5), ("tip", 0.75)]
    for wrong in (0, 4, 1.5, None):
        with pytest.raises(ValueError):
            quartile("tip", wrong)


def test_json_round_trip_sees_blanks_inside_texts(spark):
    from tidepool.operators import checks
    rows = [('{"a": 1, "t": "x y"}',), ('{"t":"x y","a":1}',), ('{"a":1,"t":"xy"}',), ('{"a":1,"t":"x","extra":2}',), ("no json",), (None,)]
    df = spark.createDataFrame(rows, "j string")
    got = [r["same"] for r in checks.json_round_trip(df, "j", "a int, t string").collect()]
    assert got == ["true", "true", "true", "false", "false", None]
    cut = checks.json_round_trip(df.limit(1), "j", "a int").first()
    assert cut["same"] == "false"
