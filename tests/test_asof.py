"""Bucketed as-of / previous row against a brute-force scan (property tests)."""

import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators import asof
from tidepool.operators.asof import Lookup, latest_before, look_up


def brute(rows, include_current, expiry, self_excluded, keyed):
    out = {}
    for r in rows:
        best = None
        for c in rows:
            if not c["cand"] or (keyed and c["k"] != r["k"]):
                continue
            if c["o"] < r["o"] or (include_current and c["o"] == r["o"]):
                if best is None or c["o"] > best["o"]:
                    best = c
        if best is not None and expiry is not None and r["o"] - best["o"] > expiry:
            best = None
        if self_excluded and r["cand"]:
            best = None
        out[r["o"]] = None if best is None else best["o"]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("mode", [
    dict(include_current=False, expiry=7, self_excluded=True, keyed=True, width=5),
    dict(include_current=False, expiry=7, self_excluded=False, keyed=False, width=30),
    dict(include_current=True, expiry=4, self_excluded=False, keyed=True, width=4),
    dict(include_current=True, expiry=None, self_excluded=False, keyed=True, width=6),
    dict(include_current=False, expiry=None, self_excluded=False, keyed=False, width=6),
    dict(include_current=False, expiry=23, self_excluded=True, keyed=False, width=2),
    dict(include_current=True, expiry=50, self_excluded=False, keyed=True, width=0.5),
])
def test_against_brute_force(spark, seed, mode):
    rnd = random.Random(seed)
    orders = rnd.sample(range(0, 400), 150)
    rows = [dict(o=o, k=rnd.choice(["a", "b", None, "c"]), cand=rnd.random() < 0.3) for o in orders]
    df = spark.createDataFrame([(r["o"], r["k"], r["cand"]) for r in rows], "o long, k string, cand boolean")
    out = latest_before(df, key="k" if mode["keyed"] else None, order="o", candidate=F.col("cand"),
                        value=F.struct(F.col("o").alias("o")), out="q",
                        include_current=mode["include_current"], expiry=mode["expiry"],
                        self_excluded=mode["self_excluded"], chunk_width=mode["width"])
    got = {r["o"]: (None if r["q"] is None else r["q"]["o"]) for r in out.collect()}
    assert got == brute(rows, mode["include_current"], mode["expiry"], mode["self_excluded"], mode["keyed"])
    assert out.count() == len(rows)


def test_plan_is_one_shuffle(spark):
    df = spark.range(1000).select(F.col("id").alias("o"), (F.col("id") % 3).alias("k"))
    out = latest_before(df, key="k", order="o", candidate=F.col("o") % 5 == 0,
                        value=F.struct(F.col("o").alias("o")), out="q", expiry=20, chunk_width=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_many_lookups_share_one_carry(spark, monkeypatch):
    monkeypatch.setattr(asof, "BLOCK", 3)
    rnd = random.Random(8)
    rows = [dict(o=o, k=rnd.choice(["a", None, "c"]), cand=rnd.random() < 0.2) for o in rnd.sample(range(400), 200)]
    df = spark.createDataFrame([(r["o"], r["k"], r["cand"], "mine") for r in rows], "o long, k string, cand boolean, key string")
    value = F.struct(F.col("o").alias("o"))
    modes = {"q0": dict(keyed=True, include_current=False, expiry=40, self_excluded=True), "q1": dict(keyed=False, include_current=True, expiry=None, self_excluded=False),
             "q2": dict(keyed=True, include_current=False, expiry=None, self_excluded=False), "q3": dict(keyed=False, include_current=False, expiry=3, self_excluded=False)}
    found = look_up(df, [Lookup("k" if m["keyed"] else None, F.col("cand"), value, out, m["include_current"], m["expiry"], m["self_excluded"])
                         for out, m in modes.items()], order="o", chunk_width=5)
    got = found.collect()
    assert found.columns == ["o", "k", "cand", "key", *modes] and len(got) == len(rows)
    for out, m in modes.items():
        assert {r["o"]: r[out] and r[out]["o"] for r in got} == brute(rows, m["include_current"], m["expiry"], m["self_excluded"], m["keyed"])


def test_narrow_chunks_make_no_single_partition_and_do_not_move_rows_twice(spark):
    df = spark.range(5000).select(F.col("id").alias("o"), (F.col("id") % 3).alias("k"))
    for key, expiry in ((None, 200), (None, None), ("k", 200)):
        out = latest_before(df, key=key, order="o", candidate=F.col("o") % 5 == 0, value=F.struct(F.col("o").alias("o")), out="q", expiry=expiry, chunk_width=10)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and plan.count("Exchange hashpartitioning") <= 2
        assert out.where("q IS NOT NULL").count() > 4900


def test_width_follows_density(spark):
    df = spark.range(10_000).select((F.col("id") / 100).alias("o"))
    assert asof.density_width(df, "o", 50, per_chunk=10_000) == 50
    assert asof.density_width(df, "o", 50, per_chunk=500) == 5
    assert asof.density_width(df.limit(0), "o", 50) == 50


def test_dense_rates_equal_sparse_ones(spark):
    from tests.conftest import SF001
    from tidepool.operators import rate
    from tidepool.plans import catalog
    from tidepool.plans import views as V
    from tidepool.sources import sinks
    prep = sinks.staged(catalog._prepared(spark, SF001), "prep")

    def rated(width):
        s = rate.delta_and_quotes(prep, base_token=V.BASE_TOKEN, usd_token=V.USD_TOKEN, expiry=100, chunk_width=width)
        return sorted(map(str, s.select("event_id", "lastPrice0", "priceDelta1", "tickDelta", "base0", "base1", "usdBase").collect()))
    assert rated(7) == rated(100) == rated(1000)
