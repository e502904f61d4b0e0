"""Conversation structure repair by Four-Russians block tables.

A repaired conversation's role initials match ``(s?(ua)+)?``. That pattern has
four states; the least cost to finish from each of them is a vector, and a row
turns the vector behind it into the one before it. Vectors less their minimum
are a small closed set, rows are one of a few symbols, so the transition of
every vector by every block of ``BLOCK`` symbols is computed once. A conversation
is then processed from its last block to its first, one lookup a block. To
trace the edits its blocks are expanded in the opposite direction, from the
first row on, where the smallest edit letter that keeps the cost is always the
right one: ties cannot go wrong, since the costs behind it are all known.

Only narrow rows (ids, turn, digest, flags) are gathered by conversation for
this, one byte a row; texts stream by once, in order, when the edits are applied.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import store, table

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
SPACE, STOPS = " \t\n\x0b\x0c\r", ".!?"
#: Rows of a block; its table has (vectors) x 10 ** BLOCK entries.
BLOCK = 4

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a; 0 and 3 may end.
# Role classes 0 s, 1 u, 2 a, 3 other. Symbols: 0 no row (padding), 1 a row that
# must go, 2 + class a sound row, 6 + class a truncated row.
SYMBOLS = 10
WANTED = (1, 1, 2, 1)
AFTER = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
ROLES = {1: "user", 2: "assistant"}
END_EDITS = ("", "II", "I", "")
LAST = tuple(INSERT * len(e) for e in END_EDITS)


def _next(state: int) -> int:
    """State after the role the pattern wants."""
    return AFTER[state, WANTED[state]]


def _options(behind: tuple, symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost with what follows, state after) that use up the row, by letter."""
    found = [("D", DELETE + behind[state], state)]
    if symbol > 1:
        role, extra = (symbol - 2) % 4, CUT if symbol > 5 else 0
        if (state, role) in AFTER:
            found.append(("K", extra + behind[AFTER[state, role]], AFTER[state, role]))
        found.append(("R", extra + REROLE + behind[_next(state)], _next(state)))
    return found


def _step(behind: tuple, symbol: int) -> tuple:
    """The vector before a row, given the one behind it."""
    if not symbol:
        return behind
    costs = [min(c for _, c, _ in _options(behind, symbol, q)) for q in range(4)]
    for _ in range(3):  # inserted rows, one after the other
        costs = [min(c, INSERT + costs[_next(q)]) for q, c in enumerate(costs)]
    return tuple(costs)


class BlockTables:
    """Transitions of all reachable normalised vectors by all symbol blocks."""

    def __init__(self, block: int = BLOCK) -> None:
        self.block = block
        self.vectors, place = [LAST], {LAST: 0}
        rows = []
        for v in self.vectors:  # grows until closed
            row = []
            for s in range(SYMBOLS):
                costs = _step(v, s)
                low = min(costs)
                key = tuple(c - low for c in costs)
                if key not in place:
                    place[key] = len(self.vectors)
                    self.vectors.append(key)
                row.append((place[key], low))
            rows.append(row)
        self.one = np.array(rows, np.int64)
        to, add = np.arange(len(rows))[:, None], np.zeros((len(rows), 1), np.int64)
        for _ in range(block):  # one more symbol at the end of every block
            add = (add[:, :, None] + self.one[to, :, 1]).reshape(len(rows), -1)
            to = self.one[to, :, 0].reshape(len(rows), -1)
        self.to, self.add = to.tolist(), add.tolist()
        self.weights = SYMBOLS ** np.arange(block - 1, -1, -1)
        self.expand = cache(self.expand)

    def expand(self, vector: int, code: int, state: int) -> tuple[str, int]:
        """Edits of a block's rows from ``state`` on, and the state after them;
        ``vector`` is the one behind the block."""
        symbols = [code // int(w) % SYMBOLS for w in self.weights]
        behind = [vector]
        for s in symbols[:-1]:
            behind.append(int(self.one[behind[-1], s, 0]))
        out = []
        for v, s in zip(reversed(behind), reversed(symbols), strict=True):
            if not s:
                continue
            h = self.vectors[v]
            costs = _step(h, s)
            while True:
                choices = _options(h, s, state) + [("I", INSERT + costs[_next(state)], _next(state))]
                edit, _, state = min(c for c in choices if c[1] == costs[state])
                out.append(edit)
                if edit != "I":
                    break
        return "".join(out), state

    def repair(self, backward: np.ndarray) -> tuple[int, str]:
        """Cost and edits of the symbols of a conversation, last row first."""
        padded = np.zeros(-(-len(backward) // self.block) * self.block, np.int64)
        padded[:len(backward)] = backward
        codes = (padded.reshape(-1, self.block) @ self.weights).tolist()
        vector, cost, behind = 0, 0, []
        for c in codes:
            behind.append(vector)
            cost += self.add[vector][c]
            vector = self.to[vector][c]
        state, out = 0, []
        for v, c in zip(reversed(behind), reversed(codes), strict=True):
            edits, state = self.expand(v, c, state)
            out.append(edits)
        return cost + self.vectors[vector][0], "".join(out) + END_EDITS[state]


@cache
def tables(block: int = BLOCK) -> BlockTables:
    return BlockTables(block)


FAULTS = ("blank", "duplicate", "truncated")
#: Fault (0 none, then FAULTS) and class of a row as one byte: 4 * fault + class.
_SYMBOL = np.array([2 + k for k in range(4)] + [1] * 8 + [6 + k for k in range(4)])
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_ILLEGAL = np.array([[(a, b) not in _LEGAL for b in range(4)] for a in range(4)])


def _clean(turns: DataFrame, copies: Column) -> DataFrame:
    """conv_id, turn, role, text, digest, copies, with nulls in role and text
    as one space. The digest is of role and text, 128 bits."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"),
                        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"), copies.cast("long").alias("copies"))


def _flagged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, digest, n and fault byte of the first of each distinct row."""
    stem = F.rtrim("text", F.lit(SPACE))
    kind = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in zip("sua", range(3), strict=True) for x in p]), F.left("role", F.lit(1))), F.lit(3))
    end = F.when(stem == "", 1).when(F.right(stem, F.lit(1)).isin(*STOPS), 0).otherwise(3)
    distinct = (rows.select("conv_id", "turn", "digest", kind.alias("kind"), end.alias("end"), "copies")
                .groupBy("conv_id", "digest", "turn").agg(F.first("kind").alias("kind"), F.first("end").alias("end"), F.sum("copies").alias("n")))
    distinct = store(distinct, "turns")
    # combined before the shuffle: a text that a conversation repeats is one row a task
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = (distinct.where("n > 0").groupBy("conv_id", "digest").agg(F.min(at).alias("at"))
             .select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), F.col("at.turn").alias("t")))
    joined = distinct.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    earlier = ~F.col("turn").eqNullSafe(F.col("t"))
    fault = F.when(F.col("end") == 1, 1).when(earlier, 2).otherwise(F.col("end"))
    return joined.select("conv_id", "turn", "digest", "n", (fault * 4 + F.col("kind")).cast("int").alias("code"))


AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audit(turns: DataFrame, copies: Column | None = None, block: int = BLOCK) -> DataFrame:
    """One row a conversation: gaps, blank, duplicate, truncated, illegal,
    cost, audit.

    Needs conv_id, turn, role, text; other columns are ignored. A conversation's
    rows go by turn (null first), ties by a digest of role and text. Null role
    and text are one space, a null conv_id is a conversation of its own. An
    initial other than s, u, a (an empty role too) cannot stay. ``copies`` says
    how often a row occurs, once if not given; 0 is no row, but its conversation
    is still listed, with zeros and an empty audit if nothing is left of it. An
    empty table has no rows. One conversation's narrow rows stream through one
    task, which keeps one byte a row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in AUDIT.split(", ")]
        types = [pa.int64()] * 7 + [pa.string()]
        key, open_, codes, span = None, False, bytearray(), [0, None, None]

        def close() -> tuple:
            code = np.frombuffer(bytes(codes), np.uint8)
            fault, kind = code // 4, code % 4
            distinct, low, high = span
            cost, edits = tables(block).repair(_SYMBOL[code])
            return (key, high - low + 1 - distinct if distinct else 0, *((fault == k).sum().item() for k in (1, 2, 3)),
                    _ILLEGAL[kind[1:], kind[:-1]].sum().item(), cost, edits)

        for b in batches:
            done = []
            for conv, turn, n, code in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not open_ or conv != key:
                    if open_:
                        done.append(close())
                    key, open_, codes, span = conv, True, bytearray(), [0, None, None]
                if not n:
                    continue
                # the later copies come first: the stream runs backward
                again = code if code // 4 == 1 else 8 + code % 4
                codes.extend(bytes([again]) * (n - 1) + bytes([code]))
                if turn is not None and turn != span[1]:
                    span = [span[0] + 1, turn, turn if span[2] is None else span[2]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True) if done else [[]] * 8, types, strict=True)], names=names)
        if open_:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*[close()], strict=True), types, strict=True)], names=names)

    narrow = _flagged(_clean(turns, F.lit(1) if copies is None else copies))
    back = narrow.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").desc_nulls_last(), F.col("digest").desc())
    return back.select("conv_id", "turn", "n", "code").mapInArrow(run, AUDIT)


def apply_edits(turns: DataFrame, audits: DataFrame, copies: Column | None = None) -> DataFrame:
    """conv_id, place (from 0), role, text of the repaired conversations, each
    one's rows one after the other in order.

    ``audits`` are those of the same turns. Texts stream by; no conversation is
    held whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, edits, at, state, place = None, "", 0, 0, 0
        out: list[tuple] = []

        def put(kind: int, role: str, text: str) -> None:
            nonlocal state, place
            out.append((key, place, role, text))
            state, place = AFTER[state, kind], place + 1

        def inserted() -> None:
            nonlocal at
            while at < len(edits) and edits[at] == "I":
                put(WANTED[state], ROLES[WANTED[state]], "")
                at += 1

        for b in batches:
            for conv, head, script, role, text, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if head:
                    inserted()  # at the end of the conversation before
                    key, edits, at, state, place = conv, script, 0, 0, 0
                    continue
                for _ in range(n):
                    inserted()
                    edit, at = edits[at], at + 1
                    if edit == "K":
                        put("sua".index(role[0]), role, text)
                    elif edit == "R":
                        put(WANTED[state], ROLES[WANTED[state]], text)
            yield batch(out)
            out.clear()
        inserted()
        yield batch(out)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)],
                                          names=["conv_id", "place", "role", "text"])

    rows = _clean(turns, F.lit(1) if copies is None else copies).where("copies > 0")
    heads = audits.select("conv_id", F.lit(True).alias("head"), "audit")
    both = heads.unionByName(rows.select("*", F.lit(False).alias("head")), allowMissingColumns=True)
    order = ["conv_id", F.col("head").desc(), F.col("turn").asc_nulls_first(), "digest"]
    streamed = both.repartition("conv_id").sortWithinPartitions(*order)
    return streamed.select("conv_id", "head", "audit", "role", "text", "copies").mapInArrow(run, "conv_id long, place long, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256 (of role:text, newline-joined), over rows in
    the order in which `apply_edits` gives them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for b in batches:
            done = []
            for conv, place, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if place == 0:
                    if sha:
                        done.append((key, sha.hexdigest()))
                    key, sha = conv, hashlib.sha256()
                sha.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            yield batch(done)
        if sha:
            yield batch([(key, sha.hexdigest())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["conv_id", "repaired_sha256"])
    return repaired.mapInArrow(run, "conv_id long, repaired_sha256 string")


def damaged(turns: DataFrame) -> tuple[DataFrame, Column]:
    """The rows after damage and how often each occurs (0, 1 or 2)."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate(as_text("text"), STOPS, "")).otherwise(as_text("text"))
    role = F.when(fate == 4, "user").otherwise(as_text("role"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("times"))
    return rows, F.col("times")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, times = damaged(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    audits = store(audit(rows, times), "audits")
    found = digests(apply_edits(rows, audits, times)).withColumnRenamed("conv_id", "c")
    empty = F.sha2(F.lit(""), 256)
    return (audits.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
            .select(*audits.columns, F.coalesce("repaired_sha256", empty).alias("repaired_sha256")))
