"""Exact rational numbers carried in string columns.

Literal form ``m e<d> b<k> / m' e<d'> b<k'>`` with value
``m * 10^-d * 2^-k`` over the same for the primed part; the exponent sign is
the reverse of scientific notation. Every part is optional: ``"0.5"``,
``"-12"``, ``"123e18"`` and ``"5e1b0/1e0b0"`` are all literals.

Contract: a null operand gives null, division by zero gives null, aggregates
skip nulls, value equality is what counts. Output literals are canonical:
``m e d b k / r e0b0`` with ``r`` coprime to 10 (see ``fmt``).

Row functions are Arrow-batched pandas UDFs: one Python loop per Arrow batch
over plain ``int`` arithmetic. Aggregates stay JVM-side: every value is cut
into signed base-10^6 limbs by place and the limbs are summed with the
built-in ``sum`` (so partial aggregation happens before any shuffle); one
UDF recombines the few limb totals per group. ``place_sums`` adds an Arrow
batch's rows of a group first, so that limbs are made once a group and batch.
"""

from __future__ import annotations

import re
from decimal import ROUND_HALF_EVEN, Context, Decimal
from functools import lru_cache
from math import gcd, isfinite

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

# ---------------------------------------------------------------------------
# pure-Python codec (the per-row helper)
# ---------------------------------------------------------------------------

_PART = re.compile(r"^\s*([+-]?)(\d*)(?:\.(\d*))?(?:e([+-]?\d+))?(?:b([+-]?\d+))?\s*$")

# binary scales at most this far above the decimal one are written as decimals
_DECIMAL_FORM_MAX_SHIFT = 64
# resolve() to text keeps this many significant digits (half-even)
RESOLVE_DIGITS = 40
_RESOLVE_CTX = Context(prec=RESOLVE_DIGITS, rounding=ROUND_HALF_EVEN)


def _part(s: str):
    """One side of a literal: ``[-]digits[.digits][e[-]d][b[-]k]``."""
    t = s.strip()
    if not t or t[0] not in "+-0123456789.":
        raise ValueError(f"not an exact literal: {s!r}")
    k = 0
    bi = t.find("b")
    if bi >= 0:
        k = int(t[bi + 1:])
        t = t[:bi]
    d = 0
    ei = t.find("e")
    if ei >= 0:
        d = int(t[ei + 1:])
        t = t[:ei]
    neg = t.startswith("-")
    if t[:1] in "+-":
        t = t[1:]
    if "." in t:
        ip, fp = t.split(".", 1)
        t = ip + fp
        d += len(fp)
    if not t or not t.isdigit():
        if _PART.match(s) is None or not t:
            raise ValueError(f"not an exact literal: {s!r}")
    num = int(t)
    den = 1
    if d >= 0:
        den = 10 ** d
    else:
        num *= 10 ** (-d)
    if k >= 0:
        den <<= k
    else:
        num <<= -k
    return (-num if neg else num), den


def parse(s):
    """Literal -> (p, q) with q > 0, or None for null / zero denominator."""
    if isinstance(s, str):
        return _parse_plain(s)
    if s is None:
        return None
    if type(s) is float:
        return _parse_other(s)
    if isinstance(s, tuple):
        return s
    if isinstance(s, int):
        return (s, 1)
    return _parse_other(s)


def _parse_other(s):
    if isinstance(s, float):  # a double column: the value of its shortest decimal text
        if not isfinite(s):
            return None
        text = repr(float(s))
        whole, _, decimals = text.partition(".")
        if decimals.isdigit():
            return int(whole + decimals), _TEN[len(decimals)]
        return Decimal(text).as_integer_ratio()
    if not isinstance(s, str):  # Decimal, numpy integer
        return Decimal(str(s)).as_integer_ratio()
    return _parse_text(s)


#: What a literal of a decimal ends with, as ``fmt`` writes it.
_SUFFIX = "b0/1e0b0"
_TEN = [10 ** d for d in range(100)]


def _parse_plain(s: str):
    """Text literal -> (p, q): decimals as ``fmt`` and SQL write them at once."""
    if s.endswith(_SUFFIX):
        m, _, d = s[:-len(_SUFFIX)].partition("e")
        if len(d) < 3 and d.isdigit() and (m.isdigit() or (m[:1] == "-" and m[1:].isdigit())):
            return int(m), _TEN[int(d)]
    else:
        whole, _, decimals = s.partition(".")
        if whole.isdigit():
            if decimals.isdigit() and len(decimals) < 100:
                return int(whole + decimals), _TEN[len(decimals)]
            if len(whole) == len(s):
                return int(s), 1
    return _parse_text(s)


@lru_cache(maxsize=1 << 16)
def _parse_text(s: str):
    """Any text literal -> (p, q); cached: prices, quotes and rates repeat a lot."""
    m, _, rest = s.partition("e")
    low, _, r = rest.partition("/")
    if r.endswith("e0b0"):  # as fmt writes fractions
        d, _, k = low.partition("b")
        r = r[:-4]
        if d.isdigit() and k.isdigit() and r.isdigit() and (m.isdigit() or (m[:1] == "-" and m[1:].isdigit())):
            q = (10 ** int(d) << int(k)) * int(r)
            return (int(m), q) if q else None
    if not s.strip():
        return None  # an empty literal (e.g. concat_ws of nulls) is no number
    if "/" in s:
        a, b = s.split("/", 1)
        n1, d1 = _part(a)
        n2, d2 = _part(b)
        p, q = n1 * d2, d1 * n2
    else:
        p, q = _part(s)
    if q == 0:
        return None
    if q < 0:
        p, q = -p, -q
    return p, q


def reduce(p: int, q: int):
    g = gcd(p, q)
    return (p // g, q // g) if g > 1 else (p, q)


#: Powers of ten as denominators, and of five, by their value.
_TENS = {10 ** d: d for d in range(_DECIMAL_FORM_MAX_SHIFT + 1)}
_FIVES = {5 ** d: d for d in range(_DECIMAL_FORM_MAX_SHIFT + 1)}
_MOST_FIVES = 5 ** _DECIMAL_FORM_MAX_SHIFT


def fmt(v) -> str | None:
    """(p, q) -> canonical literal."""
    if v is None:
        return None
    p, q = v
    if p == 0:
        return "0e0b0/1e0b0"
    d = _TENS.get(q)
    if d is not None:  # a decimal: as few places as it needs
        m = str(p)
        cut = min(len(m) - len(m.rstrip("0")), d)
        return f"{m[:-cut]}e{d - cut}b0/1e0b0" if cut else f"{m}e{d}b0/1e0b0"
    p, q = reduce(p, q)
    a = (q & -q).bit_length() - 1
    r = q >> a
    b = 0
    while (fives := gcd(r, _MOST_FIVES)) > 1:
        r //= fives
        b += _FIVES[fives]
    # value = p / (2^a 5^b r)
    if a <= b:
        m, d, k = p << (b - a), b, 0
    elif a - b <= _DECIMAL_FORM_MAX_SHIFT:
        m, d, k = p * 5 ** (a - b), a, 0
    else:
        m, d, k = p, b, a - b
    return f"{m}e{d}b{k}/{r}e0b0"


def add(x, y):
    if x is None or y is None:
        return None
    if x[1] == y[1]:
        return (x[0] + y[0], x[1])
    return (x[0] * y[1] + y[0] * x[1], x[1] * y[1])


def sub(x, y):
    if x is None or y is None:
        return None
    if x[1] == y[1]:
        return (x[0] - y[0], x[1])
    return (x[0] * y[1] - y[0] * x[1], x[1] * y[1])


def mul(x, y):
    if x is None or y is None:
        return None
    return (x[0] * y[0], x[1] * y[1])


def div(x, y):
    if x is None or y is None or y[0] == 0:
        return None
    p, q = x[0] * y[1], x[1] * y[0]
    return (-p, -q) if q < 0 else (p, q)


def sign(x):
    return None if x is None else (x[0] > 0) - (x[0] < 0)


def to_float(x):
    if x is None:
        return None
    p, q = x
    try:
        return p / q  # int / int is correctly rounded in Python
    except OverflowError:
        return float("inf") if p > 0 else float("-inf")


def to_text(x):
    """Plain decimal text, half-even to RESOLVE_DIGITS significant digits."""
    if x is None:
        return None
    p, q = reduce(*x)
    if p == 0:
        return "0"
    v = _RESOLVE_CTX.divide(Decimal(p), Decimal(q))
    t = format(v, "f")
    if "." in t:
        t = t.rstrip("0").rstrip(".")
    return t


def scale(x, dec, binary):
    """x * 10^-dec * 2^-binary."""
    if x is None or dec is None or binary is None:
        return None
    p, q = x
    dec, binary = int(dec), int(binary)
    if dec >= 0:
        q *= 10 ** dec
    else:
        p *= 10 ** (-dec)
    if binary >= 0:
        q <<= binary
    else:
        p <<= -binary
    return (p, q)


# Sums: a value is a row of signed base-10^6 limbs at places around the point.
# The limbs are kept in blocks of 21: block 0 (84 decimals, values below 10^42)
# is an array of its own, and the few values that reach further have further
# blocks, so there is no limit of width. A limb is below 10^6, so the sum of a
# place stays a bigint over more than 9 x 10^12 rows of a group.
LIMB_DIGITS = 6
LIMB_BASE = 10 ** LIMB_DIGITS
FRAC_LIMBS = 14                     # decimals in block 0: 84
N_LIMBS = 21                        # limbs of a block
SIGNIFICANT = 60                    # digits kept of a value with more decimals than block 0
_FRAC = FRAC_LIMBS * LIMB_DIGITS
_WIDTH = N_LIMBS * LIMB_DIGITS
_PLACES = 10 ** np.arange(LIMB_DIGITS - 1, -1, -1, dtype=np.int64)
# denominators 10^d up to the decimals of block 0 -> the factor that fills them
_FILL = {10 ** d: 10 ** (_FRAC - d) for d in range(_FRAC + 1)}


def fixed(x):
    """(p, q) -> (v, f): the value is v * 10^(-LIMB_DIGITS * f).

    Kept are block 0's decimals or SIGNIFICANT digits, whichever is finer; what
    lies below is rounded half-even. Decimals that are no longer are exact.
    """
    p, q = x
    fill = _FILL.get(q)
    size = (abs(p).bit_length() - q.bit_length()) * 30103 // 100000  # within 1 of the power of ten
    f = max(FRAC_LIMBS, -(-(SIGNIFICANT - size) // LIMB_DIGITS))
    if fill is not None and f == FRAC_LIMBS:
        return p * fill, f
    v, rest = divmod(abs(p) * LIMB_BASE ** f, q)
    if 2 * rest > q or (2 * rest == q and v & 1):
        v += 1
    while f > FRAC_LIMBS and v % LIMB_BASE == 0:
        v, f = v // LIMB_BASE, f - 1
    return (-v if p < 0 else v), f


def to_blocks(x) -> dict[int, list[int]]:
    """Blocks with limbs that are not 0, limbs from the highest place down."""
    return _blocks_of(*fixed(x))


def _blocks_of(v: int, f: int) -> dict[int, list[int]]:
    sign, v, out, place = (-1 if v < 0 else 1), abs(v), {}, -f
    while v:
        v, limb = divmod(v, LIMB_BASE)
        if limb:
            block, at = divmod(place + FRAC_LIMBS, N_LIMBS)
            out.setdefault(block, [0] * N_LIMBS)[N_LIMBS - 1 - at] = sign * limb
        place += 1
    return out


def from_blocks(near, far, count=1):
    """(p, q) of block 0's limb sums and (block, limbs) entries over ``count``."""
    if near is None or not count:
        return None
    blocks = [(0, near), *far]
    low = min(b for b, _ in blocks)
    total = 0
    for b, limbs in blocks:
        v = 0
        for limb in limbs:
            v = v * LIMB_BASE + int(limb)
        total += v * LIMB_BASE ** (N_LIMBS * (b - low))
    return reduce(total * LIMB_BASE ** max(0, N_LIMBS * low - FRAC_LIMBS), LIMB_BASE ** max(0, FRAC_LIMBS - N_LIMBS * low) * int(count))


def order_key(x):
    """Bytes that order as the values do, of any size.

    Decimals and binary fractions to 700 places are exact; of other quotients
    the first 120 digits count.
    """
    if x is None:
        return None
    p, q = reduce(*x)
    if p == 0:
        return b"\x01"
    twos = (q & -q).bit_length() - 1
    fives, r = 0, q >> twos
    while r % 5 == 0:
        r, fives = r // 5, fives + 1
    places = max(twos, fives)
    if r != 1 or places > 700:
        places = max(0, 121 - (abs(p).bit_length() - q.bit_length()) * 30103 // 100000)
    digits = str(abs(p) * 10 ** places // q)
    power = len(digits) - places
    digits = digits.rstrip("0")
    body = (power + (1 << 31)).to_bytes(4, "big") + bytes.fromhex(digits + "0" * (len(digits) % 2))
    return b"\x02" + body if p > 0 else b"\x00" + bytes(255 - c for c in body) + b"\xff"


def limb_arrays(values):
    """Block 0 of many (p, q) as an Arrow list array (null for None), and for
    each value its further blocks."""
    width, zero, texts, signs, far = _WIDTH, "0" * _WIDTH, [], [], []
    for x in values:
        beyond = ()
        if x is None:
            t, negative = zero, False
        else:
            v, f = fixed(x)
            negative, t = v < 0, str(abs(v))
            if f == FRAC_LIMBS and len(t) <= width:
                t = t.zfill(width)
            else:
                found = to_blocks(x)
                t = "".join(str(abs(n)).zfill(LIMB_DIGITS) for n in found.pop(0, [0] * N_LIMBS))
                beyond = tuple(found.items())
        texts.append(t)
        signs.append(-1 if negative else 1)
        far.append(beyond)
    digits = np.frombuffer("".join(texts).encode(), np.uint8).reshape(-1, N_LIMBS, LIMB_DIGITS) - 48
    limbs = digits.astype(np.int64) @ _PLACES * np.array(signs, np.int64).reshape(-1, 1)
    offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * N_LIMBS)
    return pa.ListArray.from_arrays(offsets, pa.array(limbs.ravel()), mask=pa.array([x is None for x in values], pa.bool_())), far


def rows_of(a: pa.Array) -> list:
    """The values of an Arrow array, None for null. ``to_pylist`` makes an object
    a value on the way, which for texts takes longer than to read them."""
    kind = a.type
    if pa.types.is_string(kind) or pa.types.is_large_string(kind) or (not a.null_count and (pa.types.is_floating(kind) or pa.types.is_integer(kind) or pa.types.is_boolean(kind))):
        return a.to_numpy(zero_copy_only=False).tolist()
    return a.to_pylist()


def row_groups(columns, rows: int) -> tuple[list[int], list[int]]:
    """A number for each of ``rows``, the same only for rows that are equal in
    every column (null equals null), and the first row of each number."""
    numbers = np.zeros(rows, np.int64)
    for c in columns:
        if pa.types.is_nested(c.type):
            c = pa.array(map(repr, c.to_pylist()), pa.string())
        codes = c.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        numbers = np.unique(numbers * (codes.max(initial=0) + 1) + codes, return_inverse=True)[1].reshape(-1)
    _, first, numbers = np.unique(numbers, return_index=True, return_inverse=True)
    return numbers.reshape(-1).tolist(), first.tolist()


def group_sums(values: dict[str, list], numbers: list[int], first: list[int]) -> pa.Array:
    """The sums of many (p, q) by name and group (``row_groups``) as an Arrow
    array of SUM_ROWS: a group's at its first row, none at the others. Added as
    whole numbers, the values keep all that ``fixed`` keeps of each."""
    found = [[] for _ in first]
    for name, column in values.items():
        near, counts, finer = [0] * len(first), [0] * len(first), {}
        for g, x in zip(numbers, column, strict=True):
            if x is not None:
                v, f = fixed(x)
                counts[g] += 1
                if f == FRAC_LIMBS:
                    near[g] += v
                else:
                    finer[g, f] = finer.get((g, f), 0) + v
        sums = {g: (near[g], FRAC_LIMBS) for g, n in enumerate(counts) if n}
        for (g, f), v in finer.items():
            held, at = sums[g]
            most = max(at, f)
            sums[g] = held * LIMB_BASE ** (most - at) + v * LIMB_BASE ** (most - f), most
        for g, held in sums.items():
            blocks = _blocks_of(*held)
            found[g].append({"name": name, "block": 0, "limbs": blocks.pop(0, [0] * N_LIMBS), "n": counts[g]})
            found[g] += [{"name": name, "block": k, "limbs": limbs, "n": 0} for k, limbs in blocks.items()]
    rows = [()] * len(numbers)
    for at, entries in zip(first, found, strict=True):
        rows[at] = entries
    return pa.array(rows, _SUMS_TYPE)


def extremes(values: list, numbers: list[int], groups: int) -> list[bool]:
    """Which values can be the least or the most of their group: those whose
    double, which orders as the value does, is."""
    d = np.array([to_float(x) for x in values], np.float64)
    least, most = np.full(groups, np.inf), np.full(groups, -np.inf)
    np.fmin.at(least, numbers, d)
    np.fmax.at(most, numbers, d)
    return ((d == least[numbers]) | (d == most[numbers])).tolist()


# ---------------------------------------------------------------------------
# Arrow-batched column functions
# ---------------------------------------------------------------------------

def _col(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, (int, float)):
        return F.lit(str(c))
    if isinstance(c, str):
        return F.col(c)
    raise TypeError(c)


def lit(v) -> Column:
    """An exact constant (``lit("1")``, ``lit(2**96)``)."""
    return F.lit(str(v))


def _map1(fn):
    def run(a: pa.Array) -> pa.Array:
        return pa.array([fmt(fn(parse(x))) for x in rows_of(a)], pa.string())
    return run


def _map2(fn):
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        if len(a) in (a.null_count, b.null_count):
            return pa.nulls(len(a), pa.string())
        return pa.array([None if x is None or y is None else fmt(fn(parse(x), parse(y)))
                         for x, y in zip(rows_of(a), rows_of(b), strict=True)], pa.string())
    return run


_add = arrow_udf(_map2(add), StringType())
_sub = arrow_udf(_map2(sub), StringType())
_mul = arrow_udf(_map2(mul), StringType())
_div = arrow_udf(_map2(div), StringType())
_norm = arrow_udf(_map1(lambda v: v), StringType())
_abs = arrow_udf(_map1(lambda v: None if v is None else (abs(v[0]), v[1])), StringType())
_neg = arrow_udf(_map1(lambda v: None if v is None else (-v[0], v[1])), StringType())


@arrow_udf(DoubleType())
def _to_double(a: pa.Array) -> pa.Array:
    return pa.array([to_float(parse(x)) for x in rows_of(a)], pa.float64())


@arrow_udf(DoubleType())
def _resolved(lane: pa.Array, a: pa.Array) -> pa.Array:
    """``lane``, and the value of ``a`` where that is not null."""
    if a.null_count == len(a):
        return lane
    return pa.array([x if t is None else to_float(parse(t)) for x, t in zip(rows_of(lane), rows_of(a), strict=True)], pa.float64())


@pandas_udf(StringType())
def _to_text(a: pd.Series) -> pd.Series:
    return pd.Series([to_text(parse(x)) for x in a], dtype=object)


@pandas_udf(StringType())
def _scale(a: pd.Series, d: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([fmt(scale(parse(x), dd, kk)) for x, dd, kk in zip(a, d, k)],
                     dtype=object)


#: Further blocks of a value, and the sums of named values with their number
#: (counted with block 0).
_ENTRY = [StructField("block", IntegerType()), StructField("limbs", ArrayType(LongType()))]
FAR_ROWS = ArrayType(StructType(_ENTRY))
SUM_ROWS = ArrayType(StructType([StructField("name", StringType()), *_ENTRY, StructField("n", LongType())]))


_FAR_TYPE = pa.list_(pa.struct([("block", pa.int32()), ("limbs", pa.list_(pa.int64()))]))
_SUMS_TYPE = pa.list_(pa.struct([("name", pa.string()), ("block", pa.int32()), ("limbs", pa.list_(pa.int64())), ("n", pa.int64())]))


@arrow_udf(StructType([StructField("near", ArrayType(LongType())), StructField("far", FAR_ROWS)]))
def _blocks(a: pa.Array) -> pa.Array:
    near, far = limb_arrays([parse(x) for x in rows_of(a)])
    entries = [[{"block": k, "limbs": limbs} for k, limbs in beyond] for beyond in far]
    return pa.StructArray.from_arrays([near, pa.array(entries, _FAR_TYPE)], names=["near", "far"])


@arrow_udf(BinaryType())
def _order(a: pa.Array) -> pa.Array:
    return pa.array([order_key(parse(x)) for x in rows_of(a)], pa.binary())


@arrow_udf(StringType())
def _from_blocks(near: pa.Array, far: pa.Array, n: pa.Array) -> pa.Array:
    return pa.array([fmt(from_blocks(a, [(e["block"], e["limbs"]) for e in b or ()], c))
                     for a, b, c in zip(near.to_pylist(), far.to_pylist(), n.to_pylist(), strict=True)], pa.string())


def decimal_literal(m: Column, d: Column) -> Column:
    """The literal of ``m`` (whole) with ``d`` decimals."""
    return F.concat(m.cast("string"), F.lit("e"), d.cast("string"), F.lit(_SUFFIX))


def add_(a, b) -> Column:
    return _add(_col(a), _col(b))


def sub_(a, b) -> Column:
    return _sub(_col(a), _col(b))


def mul_(a, b) -> Column:
    return _mul(_col(a), _col(b))


def div_(a, b) -> Column:
    return _div(_col(a), _col(b))


def abs_(a) -> Column:
    return _abs(_col(a))


def neg(a) -> Column:
    return _neg(_col(a))


def normalize(a) -> Column:
    return _norm(_col(a))


def resolve(a) -> Column:
    """Exact -> double (correctly rounded). A decimal's exponent is turned round
    and the built-in cast reads it, which rounds correctly too; what that cannot
    read, fractions and binary scales, goes through Python. What it has read goes
    along, so that it is read once a row."""
    a = _col(a).cast("string")
    turned = F.regexp_replace(a, rf"^(-?[0-9.]+)e(-?[0-9]+)({_SUFFIX})?$", "$1E-$2")
    lane = F.replace(turned, F.lit("E--"), F.lit("E")).try_cast("double")
    return _resolved(lane, F.when(lane.isNull(), a))


def resolve_text(a) -> Column:
    """Exact -> plain decimal text (40 significant digits, half-even)."""
    return _to_text(_col(a))


def sign_(a) -> Column:
    """-1, 0 or 1, JVM-side: canonical and plain literals keep the sign on the
    first character and are zero exactly when the mantissa is all zeros."""
    c = F.trim(_col(a))
    mant = F.regexp_extract(c, r"^[+-]?([0-9.]*)", 1)
    is_zero = F.regexp_replace(mant, r"[0.]", "") == F.lit("")
    den = F.regexp_extract(c, r"/\s*[+-]?([0-9.]*)", 1)
    den_neg = F.regexp_extract(c, r"/\s*([+-]?)", 1) == F.lit("-")
    neg_ = (F.substring(c, 1, 1) == F.lit("-")) != den_neg
    return (F.when(c.isNull(), F.lit(None).cast("int"))
            .when((den != F.lit("")) & (F.regexp_replace(den, r"[0.]", "") == F.lit("")),
                  F.lit(None).cast("int"))
            .when(is_zero, F.lit(0))
            .when(neg_, F.lit(-1))
            .otherwise(F.lit(1)))


def scale_(a, dec, binary=0) -> Column:
    """a * 10^-dec * 2^-binary: attaches token decimals and the 2^192 scale."""
    d = dec if isinstance(dec, Column) else F.lit(int(dec))
    k = binary if isinstance(binary, Column) else F.lit(int(binary))
    return _scale(_col(a), d.cast("long"), k.cast("long"))


def order_by(a) -> Column:
    """Key of an exact column that orders as the values do."""
    return _order(_col(a))


def _place_sums(limbs: Column) -> Column:
    return F.array(*[F.sum(limbs.getItem(i)) for i in range(N_LIMBS)])


def exact_sum(a) -> Column:
    """Aggregate: exact sum; null when every input is null.

    Block 0 is summed place by place, combined before the shuffle. Values that
    reach beyond it are collected by group: where many can, use ``totals``."""
    b = _blocks(_col(a))
    return _from_blocks(_place_sums(b["near"]), F.flatten(F.collect_list(b["far"])), F.least(F.count(b["near"]), F.lit(1)))


def exact_avg(a) -> Column:
    """Aggregate: exact mean, as ``exact_sum``."""
    b = _blocks(_col(a))
    return _from_blocks(_place_sums(b["near"]), F.flatten(F.collect_list(b["far"])), F.count(b["near"]))


def exact_min(a, order: Column | None = None) -> Column:
    """Aggregate: the literal of the smallest value (exact order)."""
    return F.min_by(_col(a), order if order is not None else order_by(a))


def exact_max(a, order: Column | None = None) -> Column:
    return F.max_by(_col(a), order if order is not None else order_by(a))


def place_sums(df: DataFrame, group: list[str], sums: Column, aggs=()) -> DataFrame:
    """``group``, ``aggs``, and ``__sums``, of which ``total`` and ``mean`` make
    the sum and the mean of each name.

    ``sums`` has SUM_ROWS (``group_sums``), of any names and blocks, in some row
    of the group. A row is repeated once for each entry; those repetitions are
    groups of their own that sum one block of one name, so every place is summed
    by the built-in ``sum``, combined before the shuffle, whatever the values'
    size. One more exchange of a row a group brings a group's blocks together.
    """
    none = F.lit(None).cast(SUM_ROWS.elementType)
    rows = df.select("*", F.explode(F.concat(F.array(none), F.coalesce(sums, F.array().cast(SUM_ROWS)))).alias("__sum"))
    found = rows.groupBy(*group, F.col("__sum.name").alias("__name"), F.col("__sum.block").alias("__block")).agg(
        *aggs, _place_sums(F.col("__sum.limbs")).alias("__limbs"), F.sum("__sum.n").alias("__n"))
    here = F.col("__name").isNull()
    kept = [c for c in found.columns if c not in (*group, "__name", "__block", "__limbs", "__n")]
    entry = F.struct(F.col("__name").alias("name"), F.col("__block").alias("block"), F.col("__limbs").alias("limbs"), F.col("__n").alias("n"))
    return found.groupBy(*group).agg(*[F.first(F.when(here, F.col(c)), ignorenulls=True).alias(c) for c in kept],
                                     F.collect_list(F.when(~here, entry)).alias("__sums"))


@arrow_udf(StringType())
def _from_sums(entries: pa.Array, mean: pa.Array) -> pa.Array:
    out = []
    for found, over in zip(entries.to_pylist(), mean.to_pylist(), strict=True):
        n = sum(e["n"] for e in found)
        out.append(fmt(from_blocks([0] * N_LIMBS, [(e["block"], e["limbs"]) for e in found], n if over else min(n, 1))))
    return pa.array(out, pa.string())


def _sums_of(name: str) -> Column:
    return F.filter("__sums", lambda e: e["name"] == name)


def total(name: str) -> Column:
    """Exact sum of a name after ``place_sums``; null without any value."""
    return _from_sums(_sums_of(name), F.lit(False))


def mean(name: str) -> Column:
    """Exact mean of a name after ``place_sums``."""
    return _from_sums(_sums_of(name), F.lit(True))


def totals(df: DataFrame, group: list[str], sums: dict[str, str], means: dict[str, str] | None = None) -> DataFrame:
    """``group`` and the exact sums and means (output name -> column) of exact
    columns, of any size and in any number: no group is gathered."""
    means = means or {}
    names = sorted({*sums.values(), *means.values()})

    @arrow_udf(SUM_ROWS)
    def added(*inputs: pa.Array) -> pa.Array:
        values = {n: [parse(v) for v in rows_of(x)] for n, x in zip(names, inputs)}
        return group_sums(values, *row_groups(inputs[len(names):], len(inputs[0])))
    found = place_sums(df.withColumn("__of", added(*map(_col, names), *map(_col, group))), group, F.col("__of"))
    return found.select(*group, *[total(c).alias(k) for k, c in sums.items()], *[mean(c).alias(k) for k, c in means.items()])


def register(spark) -> None:
    """SQL names for use inside ``expr`` / ``spark.sql`` text."""
    spark.udf.register("exact_add", _add)
    spark.udf.register("exact_sub", _sub)
    spark.udf.register("exact_mul", _mul)
    spark.udf.register("exact_div", _div)
    spark.udf.register("exact_abs", _abs)
    spark.udf.register("exact_resolve", _to_double)
    spark.udf.register("exact_text", _to_text)
    spark.udf.register("exact_scale", _scale)
