"""Exact top-k inner products by best-first search of M-trees.

Vectors x with inner product to a query q become points (x, sqrt(M - |x|^2)),
M the largest squared norm; the squared distance of (q, 0) to such a point is
|q|^2 + M - 2 q.x, so nearest is largest product and distances obey the
triangle inequality. Vectors are dealt to routing objects, a bounded sample;
the vectors of one routing object, in parts of bounded size, make one M-tree of
paged nodes. A node stores its object, its covering radius and its distance to
its parent's object, an entry of a leaf its distance to the leaf's object.

A query goes first into the tree whose object is nearest, which bounds its k-th
distance; after that it visits only the trees that can hold something nearer.
A block of queries searches a tree at once. Its nodes wait in a queue by the
least distance they can hold for any of them; the stored distances to the parent
rule out entries and queries before any new distance is computed, and what is
left of a page is one matrix product.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import store, table

K, SCALE, EVERY = 20, 64, 20
#: Routing objects (a sample of that many vectors), vectors of one tree and
#: entries of one page.
ROUTES, TREE, PAGE = 64, 4096, 64
#: Queries of one search task in one tree.
BLOCK = 1024
#: Products up to here are exact in floating point.
EXACT = float(1 << 53)


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and the components floor(SCALE * x) as an array of doubles.

    Rows without id or vector, and vectors with a null or non-finite
    component, take no part.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    # floor() gives longs, which large values leave: take the whole part as double
    down = F.transform(x, lambda v: F.when(F.abs(v) * SCALE < 2.0 ** 52, F.floor(v * SCALE).cast("double")).otherwise(v * SCALE))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite).select(F.col("vec_id").cast("long"), down.alias("v"))


def matrix(arrays, width: int) -> np.ndarray:
    """One row an array; shorter vectors count as zero beyond their end."""
    out = np.zeros((len(arrays), width))
    for i, a in enumerate(arrays):
        out[i, :len(a)] = a
    return out


def lift(x: np.ndarray, largest: float) -> np.ndarray:
    """Points whose distances to a query fall as its products rise."""
    return np.hstack([x, np.sqrt(np.maximum(largest - (x * x).sum(1), 0))[:, None]])


def _distance(points: np.ndarray, p: np.ndarray) -> np.ndarray:
    d = points - p
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def _distances(q: np.ndarray, points: np.ndarray) -> np.ndarray:
    """(queries x points), by one matrix product."""
    d = (q * q).sum(1)[:, None] + (points * points).sum(1) - 2 * (q @ points.T)
    return np.sqrt(np.maximum(d, 0))


class MTree:
    """Pages of at most PAGE entries over points, made from the top down."""

    def __init__(self, points: np.ndarray, seed: int = 0) -> None:
        self.points, self.rng = points, np.random.default_rng(seed)
        #: per node: object, covering radius, distance to the parent's object,
        #: child nodes or entries, distances of the entries to the object
        self.nodes: list[tuple] = []
        self.root = self.build(np.arange(len(points)), points.mean(0), 0.0)

    def build(self, members: np.ndarray, center: np.ndarray, to_parent: float) -> int:
        d = _distance(self.points[members], center)
        radius = float(d.max(initial=0.0))
        if len(members) <= PAGE or radius == 0:
            node = (center, radius, to_parent, None, members, d)
        else:
            picks = self.points[self.rng.choice(members, min(PAGE, -(-len(members) // (PAGE // 2))), replace=False)]
            near = np.argmin(np.stack([_distance(self.points[members], p) for p in picks]), 0)
            groups = [members[near == g] for g in range(len(picks))]
            if max(map(len, groups)) == len(members):  # equal points tell no pages apart
                groups = np.array_split(members, len(picks))
            children = [self.build(m, self.points[m[0]], float(_distance(self.points[m[:1]], center)[0])) for m in groups if len(m)]
            node = (center, radius, to_parent, children, None, None)
        self.nodes.append(node)
        return len(self.nodes) - 1

    def search(self, q: np.ndarray, bound: np.ndarray, found, slack: float) -> None:
        """Best-first search for a block of queries at once.

        Nodes wait by the least distance that they can hold for any query still
        interested. ``found(entries, live)`` gets a page's entries that may be
        near enough for one of the queries ``live``, and lowers their bounds in
        place. Distances to all children of a node are one matrix product, and
        only for queries and children that the stored distances do not rule out.
        """
        center, radius, *_ = self.nodes[self.root]
        d = _distances(q, center[None])[:, 0]
        queue = [(0.0, self.root, np.arange(len(q)), d)]
        while queue:
            least, k, live, d = heapq.heappop(queue)
            radius, children, members, own = self.nodes[k][1], *self.nodes[k][3:]
            on = d - radius <= bound[live] + slack
            live, d = live[on], d[on]
            if not len(live):
                continue
            reach = (bound[live] + slack)[:, None]
            if children is None:
                near = np.abs(own - d[:, None]) <= reach
                some = near.any(0)
                if some.any():
                    found(members[some], live[near.any(1)])
                continue
            radii = np.array([self.nodes[c][1] for c in children])
            to_parent = np.array([self.nodes[c][2] for c in children])
            open_ = np.abs(d[:, None] - to_parent) - radii <= reach
            some, rows = np.flatnonzero(open_.any(0)), np.flatnonzero(open_.any(1))
            if not len(some):
                continue
            far = _distances(q[live[rows]], np.stack([self.nodes[children[c]][0] for c in some]))
            open_ = open_[np.ix_(rows, some)] & (far - radii[some] <= reach[rows])
            for j, c in enumerate(some):
                its = np.flatnonzero(open_[:, j])
                if len(its):
                    heapq.heappush(queue, (max(0.0, float((far[its, j] - radii[c]).min())), children[c], live[rows[its]], far[its, j]))


class _Best:
    """The k best (score, smaller id first) of each query of a block."""

    def __init__(self, queries: np.ndarray, floor: np.ndarray, k: int) -> None:
        self.queries, self.k = queries, k
        #: scores below it are of no use; rises to the k-th best
        self.floor = floor.copy()
        self.at = self.ids = np.zeros(0, np.int64)
        self.scores = np.zeros(0)

    def add(self, live: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Take (live x ids) scores; the queries whose floor rose."""
        rows, cols = np.nonzero((scores >= self.floor[live, None]) & (ids != self.queries[live, None]))
        if not len(rows):
            return rows
        touched = np.unique(live[rows])
        mine = np.isin(self.at, touched)
        at = np.append(self.at[mine], live[rows])
        score, vec = np.append(self.scores[mine], scores[rows, cols]), np.append(self.ids[mine], ids[cols])
        order = np.lexsort((vec, -score, at))
        at, score, vec = at[order], score[order], vec[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        keep = rank < self.k
        last = rank == self.k - 1
        self.floor[at[last]] = np.maximum(self.floor[at[last]], score[last])
        self.at, self.scores, self.ids = (np.append(a[~mine], b[keep]) for a, b in ((self.at, at), (self.scores, score), (self.ids, vec)))
        return at[last]


SCHEMA = "query_id long, vec_id long, score double"


def _search(trees: DataFrame, queries: DataFrame, width: int, largest: float, k: int) -> DataFrame:
    """Each query's k best in each tree it is dealt to, given what its bound is;
    scores below that bound are left out."""
    def run(key, held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(asked):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        x, q = matrix(held["v"], width), matrix(asked["v"], width)
        norm = (q * q).sum(1)
        slack = 1e-6 * (1 + np.sqrt(max(largest, norm.max())))
        floor = asked["bound"].to_numpy(float, na_value=-np.inf)
        best = _Best(asked["query_id"].to_numpy(np.int64), floor, k)
        far = lambda s, n: np.where(np.isneginf(s), np.inf, np.sqrt(np.maximum(0.0, n + largest - 2 * np.where(np.isneginf(s), 0.0, s))))
        bound = far(floor, norm)
        sizes = held["ids"].map(len).to_numpy()
        first = np.cumsum(sizes) - sizes
        ids = np.concatenate(held["ids"].to_numpy()).astype(np.int64)

        def found(entries: np.ndarray, live: np.ndarray) -> None:
            n = sizes[entries]
            every = np.repeat(first[entries] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            scores = np.repeat(q[live] @ x[entries].T, n, axis=1)
            rose = best.add(live, scores, ids[every])
            bound[rose] = np.minimum(bound[rose], far(best.floor[rose], norm[rose]))
        MTree(lift(x, largest)).search(np.hstack([q, np.zeros((len(q), 1))]), bound, found, slack)
        return pd.DataFrame({"query_id": best.queries[best.at], "vec_id": best.ids, "score": best.scores})
    keys = ("tree", "part", "block")
    return trees.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(run, SCHEMA)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` largest products.

    Both sides have vec_id and v (see `integer_vectors`); a query does not find
    rows of its own id; ties go to the smaller id. Rows that repeat a pair of
    id and vector count once; shorter vectors count as zero beyond their end.
    Scores are exact below 2**53 and saturate as longs. Equal vectors are one
    point with its k + 1 smallest ids, which is all that can be asked of them.
    """
    spark = vectors.sparkSession
    norm = F.aggregate("v", F.lit(0.0), lambda a, v: a + v * v)
    ids = (vectors.select("v", "vec_id").distinct()
           .withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))))
    points = store(ids.where(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min("vec_id").alias("first")), "points")
    asked = store(queries.select(F.col("vec_id").alias("query_id"), "v").distinct(), "queries")
    width, largest = points.agg(F.coalesce(F.max(F.size("v")), F.lit(1)), F.coalesce(F.max(norm), F.lit(0.0))).first()
    sample = points.orderBy(F.xxhash64("v"), "first").limit(ROUTES).select("v").toPandas()
    routes = matrix(sample["v"], width) if len(sample) else np.zeros((1, width))
    shared = spark.sparkContext.broadcast(lift(routes, largest))

    def nearest(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            p = lift(matrix(pdf["v"], width), largest)
            d = _distances(p, shared.value)
            yield pdf.assign(tree=d.argmin(1), far=d.min(1))
    dealt = store(points.mapInPandas(nearest, "v array<double>, ids array<long>, first long, tree long, far double"), "dealt")
    size = dealt.groupBy("tree").agg(F.ceil(F.count(F.lit(1)) / TREE).alias("parts"), F.max("far").alias("radius")).collect()
    parts = {r["tree"]: (int(r["parts"]), float(r["radius"])) for r in size}
    of = F.create_map(*[F.lit(x) for t, (n, _) in (parts or {0: (1, 0.0)}).items() for x in (t, n)])
    trees = dealt.withColumn("part", F.pmod(F.xxhash64("v"), of[F.col("tree")])).select("tree", "part", "v", "ids")

    def plan(first: bool):
        def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names = np.array(sorted(parts), np.int64)
            radius = np.array([parts[t][1] for t in names])
            for pdf in it:
                q = matrix(pdf["v"], width)
                p = np.hstack([q, np.zeros((len(q), 1))])
                d = _distances(p, shared.value[names]) if len(names) else np.zeros((len(q), 0))
                home = d.argmin(1) if len(names) else np.zeros(len(q), int)
                at_home = home[:, None] == np.arange(len(names)) if len(names) else np.zeros((len(q), 0), bool)
                norm, bound = (q * q).sum(1), pdf["bound"].to_numpy(float)
                reach = np.sqrt(np.maximum(0.0, norm + largest - 2 * np.where(np.isnan(bound), -np.inf, bound)))
                slack = 1e-6 * (1 + np.sqrt(np.maximum(largest, norm)))
                go = at_home if first else ~at_home & (d - radius <= (reach * (1 + 1e-9) + slack)[:, None])
                row, tree = np.nonzero(go)
                count = np.array([parts[t][0] for t in names], np.int64)[tree] if len(names) else tree
                row, tree = np.repeat(row, count), np.repeat(tree, count)
                part = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                yield pd.DataFrame({"query_id": pdf["query_id"].to_numpy()[row], "v": pdf["v"].to_numpy()[row], "bound": bound[row],
                                    "tree": names[tree], "part": part}).astype({"query_id": "int64", "bound": "float64", "tree": "int64", "part": "int64"})
        return run
    schema = "query_id long, v array<double>, bound double, tree long, part long"

    def searched(rows: DataFrame, first: bool) -> DataFrame:
        # a tree's queries go to it in blocks, each with a copy of the tree
        sent = store(rows.mapInPandas(plan(first), schema), "sent")
        many = store(sent.groupBy("tree", "part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")), "blocks")
        block = F.pmod(F.xxhash64("query_id"), F.col("blocks"))
        asked_of = sent.join(many, ["tree", "part"]).select("tree", "part", block.alias("block"), "query_id", "v", "bound")
        copies = (trees.join(many.toDF("tree", "part", "n"), ["tree", "part"])
                  .select("tree", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("block"), "v", "ids"))
        return _search(copies, asked_of, width, largest, k)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rank = F.row_number().over(best)
    one = store(searched(asked.withColumn("bound", F.lit(None).cast("double")), True), "found")
    bounds = one.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound"))
    two = searched(asked.join(bounds, "query_id", "left").select("query_id", "v", "bound"), False)
    score = F.when(F.col("score") >= 2.0 ** 63, F.lit((1 << 63) - 1)).when(F.col("score") <= -2.0 ** 63, F.lit(-(1 << 63))).otherwise(F.col("score").try_cast("long"))
    return (one.unionByName(two).distinct().withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score")))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


ORACLE_SQL = f"""
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % {EVERY} = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {K}
"""
