"""Exact functions against Python Fraction (property tests) and the limb sums."""

from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepool.functions import exact as X

lits = st.builds(lambda m, d, k: f"{m}e{d}b{k}", st.integers(-10**30, 10**30),
                 st.integers(-20, 40), st.integers(0, 200))


def frac(s):
    p, q = X.parse(s)
    return Fraction(p, q)


@settings(max_examples=300, deadline=None)
@given(lits, lits)
def test_arithmetic_matches_fraction(a, b):
    fa, fb = frac(a), frac(b)
    assert frac(X.fmt(X.add(X.parse(a), X.parse(b)))) == fa + fb
    assert frac(X.fmt(X.sub(X.parse(a), X.parse(b)))) == fa - fb
    assert frac(X.fmt(X.mul(X.parse(a), X.parse(b)))) == fa * fb
    if fb != 0:
        assert frac(X.fmt(X.div(X.parse(a), X.parse(b)))) == fa / fb
    else:
        assert X.div(X.parse(a), X.parse(b)) is None


@settings(max_examples=200, deadline=None)
@given(lits)
def test_canonical_round_trip_and_resolve(a):
    v = X.parse(a)
    assert frac(X.fmt(v)) == frac(a)
    assert X.to_float(v) == float(frac(a)) or abs(frac(a)) > 10**300


def test_plain_and_scaled_literals():
    assert frac("0.5") == Fraction(1, 2)
    assert frac("123e18") == Fraction(123, 10**18)
    assert frac("5e-2") == 500
    assert frac("1e0b3") == Fraction(1, 8)
    assert X.parse(None) is None and X.parse("") is None
    assert X.parse("1/0") is None


def test_column_functions_and_sign(spark):
    rows = [("1", "2"), ("-0.5", "4"), ("0", "-3e1"), (None, "1"), ("7e0b0/3e0b0", "0")]
    df = spark.createDataFrame(rows, "a string, b string")
    out = df.select(X.add_("a", "b").alias("s"), X.mul_("a", "b").alias("m"), X.div_("a", "b").alias("d"),
                    X.sign_("a").alias("g"), X.resolve("a").alias("r"), X.abs_("a").alias("x")).collect()
    for (a, b), r in zip(rows, out):
        if a is None:
            assert r["s"] is None and r["g"] is None and r["r"] is None
            continue
        assert frac(r["s"]) == frac(a) + frac(b)
        assert frac(r["m"]) == frac(a) * frac(b)
        assert (r["d"] is None) if frac(b) == 0 else frac(r["d"]) == frac(a) / frac(b)
        assert r["g"] == (frac(a) > 0) - (frac(a) < 0)
        assert r["r"] == float(frac(a)) and frac(r["x"]) == abs(frac(a))


def test_limb_sum_avg_min_max(spark):
    import random
    rnd = random.Random(7)
    vals = [(rnd.randrange(3), f"{rnd.randint(-10**25, 10**25)}e{rnd.randint(0, 30)}") for _ in range(400)]
    vals += [(0, None), (3, None)]
    df = spark.createDataFrame(vals, "g int, v string")
    out = {r["g"]: r for r in df.groupBy("g").agg(
        X.exact_sum("v").alias("s"), X.exact_avg("v").alias("a"),
        X.exact_min("v").alias("mn"), X.exact_max("v").alias("mx")).collect()}
    for g in range(3):
        fs = [frac(v) for k, v in vals if k == g and v is not None]
        assert abs(frac(out[g]["s"]) - sum(fs)) < Fraction(1, 10**60)
        assert abs(frac(out[g]["a"]) - sum(fs) / len(fs)) < Fraction(1, 10**60)
        assert frac(out[g]["mn"]) == min(fs) and frac(out[g]["mx"]) == max(fs)
    assert out[3]["s"] is None and out[3]["mn"] is None


wide = st.builds(lambda m, d, r: f"{m}e{d}b0/{r}e0b0", st.integers(-10**40, 10**40), st.integers(-300, 300), st.sampled_from([1, 2, 7, 3 * 2**200]))


@settings(max_examples=300, deadline=None)
@given(wide)
def test_blocks_keep_decimals_or_significant_digits(a):
    v = frac(a)
    blocks = X.to_blocks(X.parse(a))
    back = Fraction(*X.from_blocks(blocks.pop(0, [0] * X.N_LIMBS), blocks.items()))
    assert abs(back - v) <= min(Fraction(1, 10**84), max(abs(v), Fraction(1, 10**400)) / 10**59)
    near, far = X.limb_arrays([X.parse(a), None])
    limbs = near.to_pylist()
    assert limbs[1] is None and Fraction(*X.from_blocks(limbs[0], far[0])) == back


@settings(max_examples=300, deadline=None)
@given(wide, wide)
def test_order_keys_order_values(a, b):
    x, y = frac(a), frac(b)
    kx, ky = X.order_key(X.parse(a)), X.order_key(X.parse(b))
    assert (kx < ky, kx > ky) == (x < y, x > y)


EXTREME = ["3.4e68", "340282366920938463463374607431768211455e-30", "1e80", "3e73", "-1e80b0/3e0b0", "7e-200", "-7e-200", "1e200", "5e0b0/3e200b190",
           "12345678901234567890.5", "0", None]


def test_sums_have_no_limit_of_width(spark):
    import random
    rnd = random.Random(3)
    rows = [(g, rnd.choice(EXTREME), rnd.choice(EXTREME)) for g in range(3) for _ in range(40)] + [(7, None, "1"), (None, "1e80", None)]
    df = spark.createDataFrame(rows, "g int, v string, w string").repartition(4)
    by_frame = {r["g"]: r for r in X.totals(df, ["g"], {"s": "v", "t": "w"}, {"a": "v"}).collect()}
    by_column = {r["g"]: r for r in df.groupBy("g").agg(X.exact_sum("v").alias("s"), X.exact_sum("w").alias("t"), X.exact_avg("v").alias("a"),
                                                        X.exact_min("v").alias("lo"), X.exact_max("v").alias("hi")).collect()}
    assert by_frame.keys() == by_column.keys() == {0, 1, 2, 7, None}
    for g, r in by_frame.items():
        vs, ws = ([frac(x[k]) for x in rows if x[0] == g and x[k] is not None] for k in (1, 2))
        for got in (r, by_column[g]):
            for name, want in (("s", sum(vs) if vs else None), ("t", sum(ws) if ws else None), ("a", sum(vs) / len(vs) if vs else None)):
                if want is None:
                    assert got[name] is None
                else:
                    assert abs(frac(got[name]) - want) < Fraction(1, 10**82)
        if vs:
            assert (frac(by_column[g]["lo"]), frac(by_column[g]["hi"])) == (min(vs), max(vs))


def test_tiny_values_are_not_lost(spark):
    df = spark.createDataFrame([("1e80",), ("3e73",), ("-3e73",)], "v string")
    assert frac(X.totals(df, [], {"s": "v"}).first()["s"]) == Fraction(1, 10**80)
    assert frac(df.agg(X.exact_sum("v")).first()[0]) == Fraction(1, 10**80)


def test_resolve_reads_decimals_and_fractions(spark):
    import random
    rnd = random.Random(12)
    vals = [f"{rnd.randint(-10**k, 10**k)}e{rnd.randint(-25, 40)}" + rnd.choice(["", "b0/1e0b0"]) for k in (1, 9, 17, 30, 70) for _ in range(60)]
    vals += ["0.5", "-12", "123e18", "5e-2", "5e1b0/3e0b0", "7e0b3", "1/3", "0e0b0/1e0b0", "1e400", "1e-400", "0.25e1", None, "", "-0", "+7", " 8 "]
    rows = spark.createDataFrame([(v,) for v in vals], "v string").select("v", X.resolve("v").alias("d")).collect()
    for r in rows:
        want = X.to_float(X.parse(r["v"]))
        assert r["d"] == want or (r["d"] is None and want is None), (r, want)
    doubles = [1.5e10, 2.5e-7, 0.1, None, -3.0]
    got = spark.createDataFrame([(v,) for v in doubles], "v double").select(X.resolve("v").alias("d")).collect()
    assert [r["d"] for r in got] == doubles


def test_swap_volume_lanes_agree(spark):
    """Whole amounts that fit are built-in decimals, all others exact in Python."""
    from tidepool.operators import enrich
    rows = []
    for a, b in [("123456789", "-5"), ("-" + "9" * 28, "9" * 28), ("1" + "0" * 60, "-1" + "0" * 40), ("0", "0"), (None, "7"), ("12.5", "-3"), ("-" + "7" * 78, "7" * 29)]:
        for fee in (3000, 0, None):
            for dec in (18, 0, None):
                rows.append((a, b, fee, dec))
    df = spark.createDataFrame([(a, b, f, (d,), (6,)) for a, b, f, d in rows], "amount0 string, amount1 string, fee int, token0 struct<decimals:int>, token1 struct<decimals:int>")
    for (a, b, fee, dec), r in zip(rows, enrich.swap_volume(df).collect(), strict=True):
        for t, raw, d in (("0", a, dec), ("1", b, 6)):
            literal = "e".join(str(x) for x in (raw, d) if x is not None)
            assert r[f"amount{t}"] == literal
            value = None if raw is None and d is None else frac(literal) if raw is not None else Fraction(d)
            taken = value * fee / 10**6 if value is not None and fee is not None and value > 0 else Fraction(0)
            assert frac(r[f"fee{t}"]) == taken
            if value is None:
                assert r[f"netAmount{t}"] is None and r[f"volume{t}"] is None
            else:
                assert frac(r[f"netAmount{t}"]) == value - taken and frac(r[f"volume{t}"]) == abs(value - taken)


def test_gas_amounts_lanes_agree(spark):
    from tidepool.sources.events import with_gas_amounts
    rows = [(21000, "50000000000e18", "30000000000e18"), (21000, "3e18", None), (None, "3e18", "5e18"), (2**40, "9" * 30 + "e18", "1e18"), (7, "0.5e18", "1e9"),
            (1, None, None), (5, "12e18", "7" * 25 + "e18")]
    got = with_gas_amounts(spark.createDataFrame(rows, "gas long, gasPrice string, baseFeePerGas string"), 18).collect()
    for (gas, price, base), r in zip(rows, got, strict=True):
        fees = gas * frac(price) if gas is not None and price else None
        tip = frac(price) - frac(base) if price and base else None
        assert (r["gasFees"] and frac(r["gasFees"])) == fees and (r["tip"] and frac(r["tip"])) == tip
    assert got[0]["gasFees"] == "1050000000000000e18b0/1e0b0"


def test_a_batch_is_summed_before_its_limbs_are_made():
    """Rows of a group in one Arrow batch give one entry a name, in its first row."""
    import pyarrow as pa
    numbers, first = X.row_groups([pa.array(["a", None, "a", "b", None]), pa.array([1, None, 1, 1, None])], 5)
    assert len(first) == 3 and numbers[0] == numbers[2] != numbers[3] and numbers[1] == numbers[4]
    literals = {"v": ["1e80", None, "3e73", "7e-200", "0.5"], "w": ["1", "2", "-3e0b0/3e0b0", None, "1e0b0/3e0b0"]}
    entries = X.group_sums({n: [X.parse(t) for t in texts] for n, texts in literals.items()}, numbers, first).to_pylist()
    assert [bool(e) for e in entries] == [True, True, False, True, False]
    for g, at in enumerate(first):
        for n, texts in literals.items():
            want = [frac(t) for t, k in zip(texts, numbers) if k == g and t is not None]
            found = [e for e in entries[at] if e["name"] == n]
            assert sum(e["n"] for e in found) == len(want)
            if want:
                got = X.from_blocks([0] * X.N_LIMBS, [(e["block"], e["limbs"]) for e in found])
                assert abs(Fraction(*got) - sum(want)) < Fraction(1, 10**83)
    assert X.extremes([X.parse(t) for t in ("1", "2", "1.5", None, "1e0b0")], [0, 0, 0, 1, 1], 2) == [True, True, False, False, True]
