"""Near-duplicate documents by HyperMinHash.

A document is the set of its word shingles. Its sketch has one register a
bucket: each shingle's hash falls into one bucket, and the bucket keeps, of its
smallest hash, the count of leading zeros and the next mantissa bits. Bands of
registers that agree make candidates; the share of equal registers, corrected
for the collisions that compressed registers have by chance, estimates the
similarity; and what passes is compared on the full sets.

Equal sets are one node, so exact copies cost no pairs. Within a band bucket
every node is first compared with the bucket's smallest node only. Nodes that
are still in different groups then matter only where a bucket mixes groups; a
node whose shingles are mostly not found in any other group cannot be linked
out of its own and is left out. The nodes that remain are joined exactly on
their full sets, by prefix tokens with length and position bounds, and only
across groups. So no link is lost and no group is expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import by_bytes, components, slices, small, store, table

SHINGLE, SIMILAR = 4, 80
BUCKETS, MANTISSA, ROWS = 128, 10, 4
SLICE, MEMORY = 2_000_000, 500_000

#: Where an empty bucket looks for a filled one: an order of its own a bucket.
ORDER = np.argsort(np.random.default_rng(7).random((BUCKETS, BUCKETS)), axis=1)
_K = np.uint64(0x9E3779B97F4A7C15)  # odd multipliers of a 64-bit mix; fixed values
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMORY:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_hashes(texts: list[bytes], size: int, known: WordHashes) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each lower-cased text."""
    split = [t.split() for t in texts]
    flat = np.array([known[w] for words in split for w in words], np.uint64)
    code = np.zeros(max(0, len(flat) - size + 1), np.uint64)
    for k in range(size):
        code = code * _K + flat[k:k + len(code)]
    code, at = _mix(code), 0
    for words in split:
        n = len(words)
        if n >= size:
            yield np.unique(code[at:at + n - size + 1])
        elif n:
            short = np.array([n], np.uint64)
            for h in flat[at:at + n]:
                short = short * _K + h
            yield _mix(short * _K)
        else:
            yield np.zeros(0, np.uint64)
        at += n


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of sorted distinct hashes, at least one: leading zeros and
    mantissa of each bucket's smallest; empty buckets copy a filled one."""
    log = np.uint64(BUCKETS.bit_length() - 1)
    first = np.searchsorted(hashes, np.arange(BUCKETS, dtype=np.uint64) << (np.uint64(64) - log))
    filled = np.append(first[1:], len(hashes)) > first
    rest = hashes[np.minimum(first, len(hashes) - 1)] << log
    zeros = np.minimum(64 - np.frexp(rest.astype(float))[1], 63).astype(np.uint64)
    out = ((zeros << np.uint64(MANTISSA)) | ((rest << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA))).astype(np.uint16)
    if not filled.all():
        source = ORDER[np.arange(BUCKETS), filled[ORDER].argmax(1)]
        out = np.where(filled, out, out[source])
    return out


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How often registers of unrelated sets of n and m shingles agree."""
    t = 2.0 ** -np.arange(64)[:, None]
    level = lambda k: -np.diff(np.vstack([1 - (1 - t) ** (k / BUCKETS), np.zeros(len(k))]), axis=0)
    return (level(np.maximum(n, BUCKETS)) * level(np.maximum(m, BUCKETS))).sum(0) / 2 ** MANTISSA


def sketches(docs: DataFrame, size: int, bits: int = 63) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (null without words), check, keys,
    registers, hashes.

    node is the first ``bits`` bits of a 128-bit hash over the set and check its
    last 63, which tell sets with the same node apart; hashes has the upper six
    bytes of each shingle's hash, in order.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in batches:
            ids, texts = list(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)), [(t or b"").lower() for t in b.column(1).cast(pa.binary()).to_pylist()]
            for i, j in slices([len(t) for t in texts], SLICE):
                out = []
                for doc, h in zip(ids[i:j], shingle_hashes(texts[i:j], size, known), strict=True):
                    if not len(h):
                        out.append((*doc, 0, None, None, None, None, None))
                        continue
                    r = registers(h)
                    band = r.view(np.uint64) + np.arange(BUCKETS // ROWS, dtype=np.uint64) * _K
                    whole = xxhash.xxh3_128_intdigest(h.tobytes())
                    out.append((*doc, len(h), whole >> (128 - bits), whole & ((1 << 63) - 1), _mix(band).view(np.int64), r.tobytes(),
                                h.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 names=["doc_id", "text_hash", "n_shingles", "node", "check", "keys", "registers", "hashes"])
    return by_bytes(docs).select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, node long, check long, keys array<long>, registers binary, hashes binary")


def _full(hashes: bytes) -> np.ndarray:
    out = np.zeros((len(hashes) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(hashes, np.uint8).reshape(-1, 6)
    return out.view(np.int64).ravel()


def _sides(pairs: DataFrame, nodes: DataFrame, column: str) -> DataFrame:
    """a, b, and sizes and ``column`` of both."""
    side = lambda k: nodes.select(F.col("node").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col(column).alias(f"x_{k}"))
    return side("a").join(small(pairs), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "x_a", "x_b")


def estimated(pairs: DataFrame, nodes: DataFrame, similar: int) -> DataFrame:
    """Pairs whose sizes allow ``similar`` and whose estimate is less than six
    deviations below it; small sets, whose registers repeat, all stay."""
    floor = similar / 100 - 6 * (similar / 100 * (1 - similar / 100) / BUCKETS) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, m = (b.column(i).to_numpy() for i in (2, 3))
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, BUCKETS) for i in (4, 5))
            c = chance(n.astype(float), m.astype(float))
            guess = ((x == y).mean(1) - c) / (1 - c)
            keep = ((guess >= floor) | (np.minimum(n, m) < BUCKETS)) & (100 * np.minimum(n, m) >= similar * np.maximum(n, m))
            yield pa.RecordBatch.from_arrays([b.column(i).filter(pa.array(keep)) for i in range(2)], names=["a", "b"])
    return _sides(pairs, nodes, "registers").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, nodes: DataFrame, similar: int) -> DataFrame:
    """Of stored pairs, those that pass the estimate and whose full sets are
    similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for n, m, x, y in zip(*(b.column(i).to_pylist() for i in range(2, 6)), strict=True):
                both = len(np.intersect1d(_full(x), _full(y), assume_unique=True))
                keep.append(100 * both >= similar * (n + m - both))
            yield pa.RecordBatch.from_arrays([b.column(i).filter(pa.array(keep, pa.bool_())) for i in range(2)], names=["a", "b"])
    likely = store(estimated(pairs, nodes, similar), "likely")
    return store(_sides(likely, nodes, "hashes").mapInArrow(run, "a long, b long"), "links")


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component."""
    keys = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("n_shingles").alias("least")).where("x <> y")
    return rows.join(small(store(keys.select("key", "least"), "keys")), "key")


def _shingles(of: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, component, shingle of the nodes in ``of`` (node, component)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for node, component, hashes in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                h = _full(hashes)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), node)), pa.array(np.full(len(h), component)), pa.array(h)], names=["node", "component", "shingle"])
    rows = nodes.select("node", "hashes").join(small(of.select("node", "component")), "node").select("node", "component", "hashes")
    return store(rows.mapInArrow(run, "node long, component long, shingle long"), "shingles")


def _can_link_out(rows: DataFrame, nodes: DataFrame, similar: int) -> DataFrame:
    """``rows`` without the nodes that no other group's node can be similar
    to: of n shingles, those in other groups too must reach the share that two
    sets of n and of the smallest size around need."""
    own = store(rows.groupBy("node", "component", "n_shingles").agg(F.min("least").alias("m")), "own")
    shingles = _shingles(own, nodes)
    met = store(shingles.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("shingle"), "met")
    common = shingles.join(small(met), "shingle", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("common"))
    # both / (n + m - both) >= s  <=>  both * (100 + s) >= s * (n + m), where
    # m is at least the smallest size around and the share s of n
    m = F.greatest(F.col("m") * 100, F.col("n_shingles") * similar)
    able = common.join(small(own), "node").where(F.col("common") * (100 + similar) * 100 >= similar * (F.col("n_shingles") * 100 + m))
    return rows.drop("least").join(small(store(able.select("node"), "able")), "node", "left_semi")


#: Sizes are classed by this factor; a prefix is as short as its classes allow.
STEP = 1.02


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n) / F.log(F.lit(STEP)))


def _least_size(size_class: Column) -> Column:
    """The smallest size of a class, whatever the logarithm's rounding."""
    m = F.ceil(F.pow(F.lit(STEP), size_class))
    return F.when(_size_class(m) < size_class, m + 1).when((m > 1) & (_size_class(m - 1) == size_class), m - 1).otherwise(m)


def _prefixes(rows: DataFrame, nodes: DataFrame, similar: int) -> DataFrame:
    """key, node, n_shingles, component, pos, common: the open nodes, keyed
    anew by the prefix tokens of an exact join on the full sets.

    A node's shingles are ordered by how few open nodes hold them. Two sets of n
    and m shingles can only be similar if the first n - t + 1 of one and the
    first m - t + 1 of the other share one, t being the intersection they need;
    sizes being classed, t is taken for the smallest m of a class. Shingles that
    no other node holds only take up places, so a copy whose own edits fill its
    prefix meets nobody. ``common`` is the share of the others.
    """
    own = store(rows.select("node", "component", "n_shingles").distinct(), "own")
    # a few hundred at most: sizes grow by STEP from class to class
    classes = [r[0] for r in own.select(_size_class(F.col("n_shingles"))).distinct().collect()]
    of = Window.partitionBy("shingle")
    counted = _shingles(own, nodes).withColumns({"df": F.count(F.lit(1)).over(of), "out": F.min("component").over(of) != F.max("component").over(of)})
    held = store(counted.where("df > 1").select("node", "shingle", "df", "out"), "held")
    n = F.col("n_shingles")
    order = Window.partitionBy("node").orderBy("df", "shingle")
    ranked = (held.join(small(own), "node")
              .withColumns({"held": F.count(F.lit(1)).over(Window.partitionBy("node")), "pos": F.row_number().over(order) - 1})
              .withColumn("pos", F.col("pos") + n - F.col("held")))
    least = F.ceil(n * similar / 100)
    need = lambda q: F.ceil((n + F.greatest(least, _least_size(q))) * similar / (100 + similar))
    low, high = _size_class(least), _size_class(F.floor(n * 100 / similar))
    others = F.filter(F.lit(sorted(classes)).cast("array<bigint>"), lambda q: (q >= low) & (q <= high) & (F.col("pos") <= n - need(q)))
    near = ranked.where(F.col("out") & (F.col("pos") <= n - least)).withColumns({"own": _size_class(n), "other": F.explode(others)})
    key = F.xxhash64("shingle", F.least("own", "other"), F.greatest("own", "other"))
    return store(near.select(key.alias("key"), "node", "n_shingles", "component", "pos", (F.col("held") / n).alias("common")), "prefixes")


def _nodes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and one row a node. Different sets that share a node's bits (a few
    among 10^11) are told apart by their other bits and get nodes of their own."""
    def grouped(rows: DataFrame) -> DataFrame:
        return store(rows.where("node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("first_id"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("keys").alias("keys"),
            F.min("check").alias("low"), F.max("check").alias("high")), "nodes")
    nodes = grouped(rows)
    clash = nodes.where("low <> high").select("node", F.lit(True).alias("clash"))
    if clash.limit(1).count():
        own = F.when(F.col("clash"), F.xxhash64("node", "check")).otherwise(F.col("node"))
        rows = store(rows.join(small(clash), "node", "left").withColumn("node", own).drop("clash"), "sketches")
        nodes = grouped(rows)
    return rows, nodes.drop("low", "high")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, similar: int = SIMILAR, bits: int = 63) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept of each row.

    Rows without words are linked with nothing. Rows with equal sets are one
    group whatever their ids. component_id is the smallest id in the group;
    rows without an id take part but give none, and are kept where their group
    has no id at all. Other columns are ignored; rows that repeat an id each
    have their own set.
    """
    rows, nodes = _nodes(store(sketches(docs, size, bits), "sketches"))
    bands = nodes.select("node", "n_shingles", F.explode("keys").alias("key"))
    shared = store(bands.groupBy("key").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "center"), "shared")
    members = store(bands.join(small(shared), "key"), "members")
    # one row of each node that is in some bucket with another
    wanted = store(members.select("node").distinct(), "wanted")
    full = store(rows.select("node", "n_shingles", "registers", "hashes").join(small(wanted), "node", "left_semi").groupBy("node").agg(
        *[F.any_value(c).alias(c) for c in ("n_shingles", "registers", "hashes")]), "sets")
    star = members.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    links = verified(store(star, "pairs"), full, similar)
    groups = lambda: store(components(wanted.withColumnRenamed("node", "id"), links), "components")

    def mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
        """The rows of buckets that still mix groups."""
        named = rows.join(small(labels.withColumnRenamed("id", "node")), "node")
        return store(_mixed(named), "open")

    labels = groups()
    open_rows = mixed(members.select("key", "node", "n_shingles"), labels)
    for _ in range(2):
        if not open_rows.limit(1).count():
            break
        open_rows = store(_mixed(_can_link_out(open_rows, full, similar)), "open")
    if open_rows.limit(1).count():
        # what is left is joined exactly, first with each prefix token's most common node
        keyed = store(_mixed(_prefixes(open_rows, full, similar)).drop("least"), "open")
        most = F.max_by(F.struct(F.col("node").alias("a"), F.col("component").alias("its")), F.struct("common", "node")).alias("c")
        center = store(keyed.groupBy("key").agg(most).select("key", "c.*"), "centers")
        met = keyed.join(small(center), "key").where("component <> its").select("a", F.col("node").alias("b"))
        more = verified(store(met.distinct(), "pairs"), full, similar)
        if more.limit(1).count():
            links = store(links.unionByName(more), "links")
            labels = groups()
            keyed = mixed(keyed.drop("component"), labels)
        sides = (keyed.select("key", *[F.col(c).alias(f"{c[0]}_{k}") for c in ("node", "component", "pos")], F.col("n_shingles").alias(f"size_{k}")) for k in "ab")
        n, m = F.col("size_a"), F.col("size_b")
        close = F.least(n, m) * 100 >= F.greatest(n, m) * similar
        # what can still be common from the shared token's places on
        room = F.least(n - F.col("p_a"), m - F.col("p_b")) * (100 + similar) >= (n + m) * similar
        left, right = sides
        across = left.join(right, (left["key"] == right["key"]) & (F.col("c_a") < F.col("c_b")) & close & room)
        across = store(across.select(F.col("n_a").alias("a"), F.col("n_b").alias("b")).distinct(), "pairs")
        more = verified(across, full, similar)
        if more.limit(1).count():
            links = store(links.unionByName(more), "links")
            labels = groups()

    # most nodes are linked with none: only the others have a group to name
    grouped = nodes.select("node", "first_id").join(small(labels.withColumnRenamed("id", "node")), "node")
    smallest = store(grouped.groupBy("component").agg(F.min("first_id").alias("component_id")), "smallest")
    named = store(small(labels).join(small(smallest), "component").select(F.col("id").alias("node"), "component_id", F.lit(True).alias("grouped")), "named")
    of_node = nodes.select("node", "first_id").join(small(named), "node", "left").select(
        "node", F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id"))
    out = rows.select("doc_id", "text_hash", "n_shingles", "node").join(of_node, "node", "left")
    group = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", group.alias("component_id"), F.coalesce(F.col("doc_id") == group, group.isNull()).alias("kept"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text")).drop("text_hash")
