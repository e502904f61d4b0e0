"""Line deduplication by a segment-partition edit join, in DataFrame operations.

Lines within ``errors`` edits of each other form groups; a group keeps its
first line. Each line is cut into errors + 1 segments; a line within that many
edits has one of them unchanged, at a place that the lengths and the segment's
number bound. Lines are indexed by segment and length, and probe the index with
the substrings that can be a segment of a line of each length.

A key that many lines share is split again: what stands left and right of the
shared segment has its own, smaller error bound, so the larger open part is
segmented in turn and its segment joins the key, until few lines share a key or
no part is long enough to be cut. Candidates are verified by a banded
bit-parallel edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import components, free, small, store, table

#: Edits between lines that count as one; shorter lines are left alone; lines
#: that may share a key before it is split.
ERRORS, SHORTEST, CROWD = 1, 24, 32
#: Characters that verification compares at once from both ends.
BLOCK = 16

_SCHEMA_PARTS = "array<struct<other:int,start:int,own:int,errors:int>>"


def once(df: DataFrame, *kept: str, **columns: Column) -> DataFrame:
    """``kept`` and new columns, each computed once a row: the optimiser would
    write a plain projection's expressions into all places that use them."""
    made = F.explode(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))).alias("_once")
    return df.select(*kept, made).select(*kept, "_once.*")


def lines(docs: DataFrame, shortest: int) -> DataFrame:
    """doc_id, doc (hash of the text), place (id and position in one ordered
    number), pos, line, n (its length), id (its hash)."""
    each = docs.select("doc_id", F.xxhash64("text").alias("doc"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    each = once(each, "doc_id", "doc", "pos", "line", n=F.length("line")).where(F.col("n") >= shortest)
    first = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).cast("decimal(20,0)")
    return each.select("doc_id", "doc", (first * F.lit(1 << 31).cast("decimal(11,0)") + F.col("pos")).cast("decimal(38,0)").alias("place"),
                       "pos", "line", "n", F.xxhash64("line").alias("id"))


def _segment(length: Column, k: int, n: int) -> tuple[Column, Column]:
    """Start and size of segment k (from 1) of n; the last ones are longer."""
    q, longer = F.floor(length / n).cast("int"), (length % n).cast("int")
    return q * (k - 1) + F.greatest(F.lit(0), longer - (n - k + 1)), q + F.when(longer > n - k, 1).otherwise(0)


def _entries(own: Column, start: Column, errors: int, others: list[tuple[Column, int]], text: Column, salt: Column, rest: Column | None, parts: bool = True) -> Column:
    """Index entries (role 1) and probes (role 2) of one open part, exploded
    as ``e``; null where one doesn't fit.

    The part has ``own`` characters from ``start``; ``others`` are the lengths
    it may have in another line, each with the roles it is asked in. The shift
    of segment k is at most k - 1 errors before it and errors - k + 1 after it.
    """
    found, n = [], errors + 1
    for other, roles in others:
        delta = own - other
        for k in range(1, n + 1):
            at, size = _segment(other, k, n)
            for shift in range(1 - k, k):
                p = at + shift
                fits = (size > 0) & (F.abs(F.lit(shift) - delta) <= n - k) & (p >= 0) & (p + size <= own)
                role = F.when((delta == 0) & F.lit(shift == 0), roles).otherwise(roles & 2)
                key = F.xxhash64(salt, F.lit(k), other, size, text.substr(start + p + 1, size))
                left = F.struct(at.alias("other"), start.alias("start"), p.alias("own"), F.lit(k - 1).alias("errors"))
                right = F.struct((other - at - size).alias("other"), (start + p + size).alias("start"), (own - p - size).alias("own"), F.lit(n - k).alias("errors"))
                made = [key.alias("key"), role.cast("int").alias("role")]
                if parts:
                    made.append((F.array(left, right) if rest is None else F.concat(rest, F.array(left, right))).cast(_SCHEMA_PARTS).alias("parts"))
                found.append(F.when(fits & (role > 0), F.struct(*made)))
    return F.explode(F.array(*found)).alias("e")


def line_entries(rows: DataFrame, errors: int, parts: bool) -> DataFrame:
    """id, line, key, role (and open parts) of whole lines; ``rows`` has id,
    line and n."""
    others = [(F.col("n") - d, 3 if d == 0 else 2) for d in range(errors + 1)]
    e = _entries(F.col("n"), F.lit(0), errors, others, F.col("line"), F.lit(0).cast("long"), None, parts)
    return rows.select("id", "line", e).where("e IS NOT NULL").select("id", "line", "e.*")


def _met(rows: DataFrame) -> DataFrame:
    """Keys that an index entry and a probe of different lines share."""
    return (rows.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.bit_or("role").alias("roles"), F.count(F.lit(1)).alias("n"))
            .where("low <> high AND roles = 3"))


def _refined(rows: DataFrame, errors: int) -> DataFrame:
    """The rows of crowded keys by the next segment of their larger part."""
    # parts that can be cut first, then the longest; the same on all lines of a key
    order = lambda x: F.struct((x["other"] > x["errors"]).alias("cut"), x["other"].alias("other"), x["errors"].alias("errors"))
    longest = F.array_sort("parts", lambda x, y: F.when(order(x) > order(y), -1).when(order(x) < order(y), 1).otherwise(0))
    rows = once(rows, "id", "line", "key", "role", parts=longest)
    rows = once(rows, "id", "line", "key", "role", p=F.element_at("parts", 1), rest=F.slice("parts", 2, 100))
    out = None
    for e in range(errors + 1):
        made = _entries(F.col("p.own"), F.col("p.start"), e, [(F.col("p.other"), 2)], F.col("line"), F.col("key"), F.col("rest"))
        part = rows.where(F.col("p.errors") == e).select("id", "line", "role", made).where("e IS NOT NULL")
        part = part.select("id", "line", F.col("e.key").alias("key"), "role", F.col("e.parts").alias("parts"))
        out = part if out is None else out.unionByName(part)
    # a line stays in the index by its own segments; shifted cuts are probes
    return out.withColumn("role", F.when(F.expr("exists(parts, x -> x.own <> x.other)"), 2).otherwise(F.col("role")))


def candidates(rows: DataFrame, errors: int, crowd: int) -> DataFrame:
    """(a, b), a < b, of line ids that share a key; ``rows`` has id and line."""
    state, pairs = store(line_entries(once(rows, "id", "line", n=F.length("line")), errors, True), "entries"), None
    while True:
        met = store(_met(state), "keys")
        # lines that differ only in parts too short to be cut are as few as
        # such parts can be written
        ended = F.expr("NOT exists(parts, x -> x.other > x.errors)")
        state = state.join(met.select("key", "low", "n"), "key").withColumn("few", (F.col("n") <= crowd) | ended)
        state = store(state, "entries")
        few = state.where("few")
        index = few.where("role % 2 = 1").select("key", F.col("id").alias("x"))
        probe = few.where("role >= 2").select("key", F.col("id").alias("y"))
        got = store(index.join(probe, "key").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "pairs")
        pairs = got if pairs is None else pairs.unionByName(got)
        state = state.where("NOT few").select("id", "line", "key", "role", "parts")
        if not state.limit(1).count():
            return pairs.distinct()
        state = store(_refined(state, errors), "entries")


def _matching_blocks(a: Column, b: Column) -> Column:
    """How many whole blocks two strings have in common at their start."""
    upto = F.floor(F.least(F.length(a), F.length(b)) / BLOCK).cast("int")
    same = F.transform(F.sequence(F.lit(0), upto), lambda k: (k < upto) & (a.substr(k * BLOCK + 1, F.lit(BLOCK)) == b.substr(k * BLOCK + 1, F.lit(BLOCK))))
    return (F.array_position(same, F.lit(False)) - 1).cast("int")


def verified(pairs: DataFrame, errors: int) -> DataFrame:
    """(a, b) of the pairs whose lines ``line_a`` and ``line_b`` are within
    ``errors`` edits. Blocks that are equal at the start, and then at the end,
    are left out of the comparison; one edit leaves less than two blocks."""
    rows = pairs.where(F.abs(F.length("line_a") - F.length("line_b")) <= errors)
    both = ("a", "b", "line_a", "line_b")
    for _ in range(2):  # from the start, then from the end
        rows = once(rows, *both, k=_matching_blocks(F.col("line_a"), F.col("line_b")) * BLOCK)
        rows = once(rows, "a", "b", **{f"line_{x}": F.expr(f"reverse(substr(line_{x}, k + 1))") for x in "ab"})
    if errors == 1:
        rows = rows.where(F.greatest(F.length("line_a"), F.length("line_b")) <= 2 * BLOCK)
    return once(rows, "a", "b", near=within(F.col("line_a"), F.col("line_b"), errors)).where("near").select("a", "b")


def within(a: Column, b: Column, errors: int) -> Column:
    """Whether two strings are at most ``errors`` edits apart.

    Bit-parallel edit distance in a band: bit k of the vertical differences at
    column i stands for row i - errors + k. The distance is followed down the
    band's lowest diagonal and then along the last row.
    """
    width = 2 * errors + 2
    mask, top = (1 << width) - 1, width - 1
    x, y = F.split(a, ""), F.split(b, "")
    rows, cols = F.length(a), F.length(b)
    long = lambda v: F.lit(v).cast("long")
    inv = lambda v: v.bitwiseXOR(long(mask))
    # bit `top` is row i + errors at column i, so bit k is row i + errors - top + k
    first = sum(1 << k for k in range(width) if errors - top + k >= 0)
    start = F.struct(long(first).alias("vp"), long(0).alias("vn"), F.least(rows, F.lit(errors)).cast("long").alias("d"))

    def step(acc: Column, i: Column) -> Column:
        c = F.get(y, i)
        same = None
        for k in range(width):
            bit = F.when(F.get(x, i + (errors - top + k)).eqNullSafe(c) & (i + (errors - top + k) >= 0), long(1 << k)).otherwise(long(0))
            same = bit if same is None else same.bitwiseOR(bit)
        return F.transform(F.array(F.struct(same.alias("pm"), acc.alias("s"), i.alias("i"))), lambda t: carry(t["pm"], t["s"], t["i"]))[0]

    def carry(pm: Column, s: Column, i: Column) -> Column:
        vp, vn = s["vp"], s["vn"]
        d0 = (pm.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(pm).bitwiseOR(vn).bitwiseAND(long(mask))
        return F.transform(F.array(d0), lambda z: fall(z, vp, vn, s["d"], i))[0]

    def fall(d0: Column, vp: Column, vn: Column, d: Column, i: Column) -> Column:
        hp = vn.bitwiseOR(inv(d0.bitwiseOR(vp)))
        hn = d0.bitwiseAND(vp)
        down = F.shiftrightunsigned(d0, 1)
        # the last row is bit `at` of this column once the band has passed it
        at = rows - 1 - i - errors + top
        here = lambda v: F.when(at >= 0, F.call_function("shiftright", v, at).bitwiseAND(long(1))).otherwise(long(0))
        moved = F.when(at >= top, F.when(d0.bitwiseAND(long(1 << top)) == 0, long(1)).otherwise(long(0))).otherwise(here(hp) - here(hn))
        return F.struct(hn.bitwiseOR(inv(down.bitwiseOR(hp))).alias("vp"), down.bitwiseAND(hp).alias("vn"), (d + moved).alias("d"))

    done = F.aggregate(F.sequence(F.lit(0), cols - 1), start, step)
    return F.when((rows == 0) | (cols == 0), rows + cols <= errors).when(F.abs(rows - cols) > errors, False).otherwise(done["d"] <= errors)


def line_groups(docs: DataFrame, errors: int = ERRORS, shortest: int = SHORTEST, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """All lines' places, and (id, n, place, links, first) of lines that are
    there again or nearly: ``first`` is the place of their group's first."""
    each = lines(docs, shortest)
    seen = store(each.groupBy("id").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n")), "lines")
    keys = store(_met(line_entries(each, errors, False)).select("key"), "keys")
    near = line_entries(each, errors, False).join(small(keys), "key", "left_semi")
    texts = store(near.groupBy("id").agg(F.min("line").alias("line")), "texts")
    pairs = candidates(texts, errors, crowd)
    side = lambda k: texts.select(F.col("id").alias(k), F.col("line").alias(f"line_{k}"))
    links = store(verified(pairs.join(side("a"), "a").join(side("b"), "b"), errors), "links")
    ends = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("links"))
    groups = components(ends.select("id"), links)
    again = seen.join(ends, "id", "left").where("n > 1 OR links IS NOT NULL").join(groups, "id", "left")
    again = store(again.select("id", "n", "place", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("component")), "again")
    firsts = again.groupBy("component").agg(F.min("place").alias("first"))
    return each, again.join(firsts, "component").select("id", "n", "place", "links", "first")


def dedup_lines(docs: DataFrame, errors: int = ERRORS, shortest: int = SHORTEST, crowd: int = CROWD) -> DataFrame:
    """All columns of ``docs`` with text without its repeated lines, plus
    n_lines, n_repeated, n_near, n_links; columns of these names are replaced.

    A line of at least ``shortest`` characters goes if an earlier line (by
    document id, then position) is the same or in the same group; n_near counts
    those whose very text is not there earlier, n_links the other texts that
    the document's lines are directly linked with. Shorter lines stay.
    Null text stays null with no lines. Null ids come first. Rows of equal id
    and text are one document; rows of equal id are told apart by their text.
    """
    each, again = line_groups(docs, errors, shortest, crowd)
    found = each.select("doc_id", "doc", "place", "pos", "id").join(again.withColumnRenamed("place", "own"), "id")
    gone = store(found.groupBy("doc_id", "doc").agg(
        F.collect_set(F.when(F.col("place") != F.col("first"), F.col("pos"))).alias("gone"),
        F.count_distinct(F.when((F.col("place") != F.col("first")) & (F.col("place") == F.col("own")), F.col("pos"))).alias("near"),
        F.sum("links").alias("links")).withColumnRenamed("doc_id", "its_id"), "gone")
    outputs = ("n_lines", "n_repeated", "n_near", "n_links")
    kept = [c for c in docs.columns if c.lower() not in outputs]
    # one struct under a free name: no column of the caller's is in its way
    found, doc, its_id = (free(docs, c) for c in ("found", "doc", "its_id"))
    own = docs.select(*kept, F.xxhash64("text").alias(free(docs, "hash")))
    hash_ = own.columns[-1]
    gone = gone.select(F.col("doc").alias(doc), F.col("its_id").alias(its_id), F.struct("gone", "near", "links").alias(found))
    joined = own.join(small(gone), (F.col(hash_) == F.col(doc)) & F.col("doc_id").eqNullSafe(F.col(its_id)), "left")
    parts, lost = F.split("text", "\n"), F.coalesce(F.col(found)["gone"], F.array().cast("array<int>"))
    left = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(lost, i)), "\n")
    zero = F.lit(0).cast("long")
    return joined.select(*[F.when(F.size(lost) > 0, left).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c) for c in kept],
                         F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"), F.size(lost).cast("long").alias("n_repeated"),
                         F.coalesce(F.col(found)["near"], zero).alias("n_near"), F.coalesce(F.col(found)["links"], zero).alias("n_links"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_repeated", "n_near", "n_links", F.md5("text").alias("text_md5"))


ORACLE_SQL = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, pos, line, CAST(doc_id AS HUGEINT) * 2147483648 + pos AS place FROM (
    SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos, unnest(string_split(text, chr(10))) AS line FROM documents)),
t AS (SELECT line, min(place) AS own, count(*) AS n FROM l WHERE length(line) >= {SHORTEST} GROUP BY line),
h AS (SELECT line, length(line) // 2 AS h, length(line) AS n, left(line, length(line) // 2) AS a, substr(line, length(line) // 2 + 1) AS b FROM t),
p AS (
  SELECT x.line AS a, y.line AS b FROM h x JOIN h y ON y.n = x.n AND y.a = x.a AND x.line <> y.line
  UNION SELECT x.line, y.line FROM h x JOIN h y ON y.n = x.n AND y.b = x.b AND x.line <> y.line
  UNION SELECT x.line, y.line FROM h x JOIN (SELECT line, n, left(line, (n - 1) // 2) AS a FROM h) y ON y.n = x.n + 1 AND y.a = x.a
  UNION SELECT x.line, y.line FROM h x JOIN (SELECT line, n, substr(line, (n - 1) // 2 + 2) AS b FROM h) y ON y.n = x.n + 1 AND y.b = x.b),
k AS (SELECT a, b FROM p WHERE levenshtein(a, b) <= {ERRORS}),
e AS (SELECT a, b FROM k UNION SELECT b, a FROM k),
r(a, b) AS (SELECT line, line FROM t UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
f AS (SELECT r.a AS line, min(t.own) AS first FROM r JOIN t ON t.line = r.b GROUP BY r.a),
d AS (SELECT a AS line, count(*) AS links FROM e GROUP BY a),
j AS (SELECT l.*, t.own, f.first, coalesce(d.links, 0) AS links FROM l LEFT JOIN t USING (line) LEFT JOIN f USING (line) LEFT JOIN d USING (line))
SELECT doc_id, count(*) AS n_lines, count(CASE WHEN place <> first THEN 1 END) AS n_repeated,
  count(CASE WHEN place <> first AND place = own THEN 1 END) AS n_near,
  CAST(coalesce(sum(links), 0) AS BIGINT) AS n_links,
  md5(coalesce(string_agg(CASE WHEN first IS NULL OR place = first THEN line END, chr(10) ORDER BY pos), '')) AS text_md5
FROM j GROUP BY doc_id
"""
