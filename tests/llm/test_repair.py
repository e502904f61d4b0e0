"""Conversation repair against an exhaustive search."""

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from llm import conversation_repair as repair
from tests.llm.helpers import SMALL, rows_of

SPACE = " \t\n\x0b\x0c\r"
TURNS = "conv_id long, turn long, role string, text string"


def row_faults(rows):
    """First fault of each (role, text): '', blank, duplicate, truncated."""
    seen, out = set(), []
    for role, text in rows:
        stem = text.rstrip(SPACE)
        out.append("blank" if not stem else "duplicate" if (role, text) in seen else "truncated" if stem[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) over every script that fits, by its costs
    and then its letters; scripts are followed row by row."""
    faults = row_faults(rows)

    @functools.cache
    def best(i, state):  # state: '' nothing, s, u, a (last initial)
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if i < len(rows):
            role, text = rows[i]
            add = lambda c, e, got, x: found.append((c + x[0], e + x[1], got + x[2]))
            add(2, "D", (), best(i + 1, state))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] == "truncated" else 0
                if (state, role[:1]) in (("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")):
                    add(extra, "K", ((role, text),), best(i + 1, role[0]))
                new = "assistant" if state == "u" else "user"
                add(extra + 1, "R", ((new, text),), best(i + 1, new[0]))
        # an inserted row: at most two in a row are ever of use
        new = "assistant" if state == "u" else "user"
        found.append(step(i, new, 1))
        return min(x for x in found if x)

    @functools.cache
    def step(i, new, left):
        tails = [x for x in [after(i, new[0], left)] if x]
        return min(((5 + c, "I" + e, ((new, ""), *got)) for c, e, got in tails), default=None)

    @functools.cache
    def after(i, state, left):
        found = []
        if i == len(rows) and state == "a":
            found.append((0, "", ()))
        if i < len(rows):
            role, text = rows[i]
            c, e, got = best_used(i, state)
            found.append((c, e, got))
        if left:
            found.append(step(i, "assistant" if state == "u" else "user", left - 1))
        return min((x for x in found if x), default=None)

    @functools.cache
    def best_used(i, state):
        """The cheapest that uses row i next."""
        role, text = rows[i]
        found = [(2, "D", (), best(i + 1, state))]
        if faults[i] not in ("blank", "duplicate"):
            extra = 5 if faults[i] == "truncated" else 0
            if (state, role[:1]) in (("s", "u"), ("u", "a"), ("a", "u")):
                found.append((extra, "K", ((role, text),), best(i + 1, role[0])))
            new = "assistant" if state == "u" else "user"
            found.append((extra + 1, "R", ((new, text),), best(i + 1, new[0])))
        return min((c + x[0], e + x[1], got + x[2]) for c, e, got, x in found)

    return best(0, "")


def expected(rows):
    """One conversation's result over (turn, role, text), in order."""
    pairs = [(r, t) for _, r, t in rows]
    faults = row_faults(pairs)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for r, _ in pairs]
    cost, audit, fixed = cheapest(tuple(pairs))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in fixed))
    return {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **{f: faults.count(f) for f in repair.FAULTS},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()}


def damage(conv, turn, role, text):
    name = lambda x: " " if x is None else str(x)
    role, text = name(role), name(text)
    match zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20:
        case 0:
            return []
        case 1:
            return [(turn, role, "")]
        case 2:
            return [(turn, role, re.sub("[.!?]", "", text))]
        case 3:
            return [(turn, role, text)] * 2
        case 4:
            return [(turn, "user", text)]
    return [(turn, role, text)]


def by_conversation(rows):
    """Rows after damage; ties of a turn by the operator's digest."""
    def order(r):
        turn, role, text = r
        return turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).extend(damage(conv, turn, role, text))
    return {c: sorted(found, key=order) for c, found in out.items()}


def held_against(got, rows):
    want = by_conversation(rows)
    assert len(got) == len(want)
    for r in got:
        assert {k: v for k, v in r.items() if k != "conv_id"} == expected(want[r["conv_id"]]), r["conv_id"]


def run(spark, df):
    rows, times = repair.damaged(df)
    audits = repair.store(repair.audit(rows, times), "audits")
    found = {r["conv_id"]: r["repaired_sha256"] for r in rows_of(repair.digests(repair.apply_edits(rows, audits, times)))}
    return [r | {"repaired_sha256": found.get(r["conv_id"], hashlib.sha256().hexdigest())} for r in rows_of(audits)]


@pytest.mark.parametrize("block", [1, 3, 4])
def test_tables_give_the_cheapest_edits(block):
    rng = random.Random(block)
    roles, texts = ["system", "user", "assistant", "tool", ""], ["a.", "b!", "c", "", "d?", "e f"]
    table = repair.BlockTables(block)
    code = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
    for _ in range(1500):
        rows = tuple((rng.choice(roles), rng.choice(texts) + rng.choice(["", " x.", " y", str(rng.random()) + "."])) for _ in range(rng.randrange(0, 11)))
        symbols = [repair._SYMBOL[4 * code[f] + "sua".find(r[:1] or "x") % 4] for f, (r, _) in zip(row_faults(rows), rows, strict=True)]
        assert table.repair(symbols[::-1]) == cheapest(rows)[:2], rows


def test_vectors_are_a_small_closed_set():
    assert len(repair.tables().vectors) < 200
    assert all(min(v) == 0 for v in repair.tables().vectors)


def test_query_on_the_smallest_table(spark):
    got = rows_of(repair.op12_conversation_repair(spark, SMALL))
    held_against(got, [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])


def test_awkward_conversations(spark):
    long = "w " * 100_000 + "."
    rows = [(1, None, "system", "a."), (1, None, "user", "b."), (1, 5, "assistant", "c."), (1, 9, None, None), (2, 0, "user", long), (2, 0, "user", long),
            (2, 1, "assistant", ""), (None, 3, "user", "q?"), (None, None, "assistant", " \t"), (3, 0, "", "x."), (4, None, None, None),
            (5, -4, "user", "é　"), (5, -4, "assistant", "é　."), (5, -4, "user", "é　")]
    rows += [(c, 0, "user", "only.") for c in range(100, 160)]  # some lose their only row
    rows += [(7, t, ["user", "assistant", "system"][t % 3], "same." if t % 2 else f"n{t}.") for t in range(3_00)]
    df = spark.createDataFrame([(*r, 1, 2, True) for r in rows], f"{TURNS}, copies int, times int, head boolean")
    held_against(run(spark, df), rows)
    assert run(spark, df.limit(0)) == []


def test_repaired_turns_are_the_real_rows(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "user", "u."), (1, 2, "user", "v."), (1, 3, "assistant", "a.")]
    df = spark.createDataFrame(rows, TURNS)
    audits = repair.store(repair.audit(df), "audits")
    assert [(r["cost"], r["audit"]) for r in rows_of(audits)] == [(2, "KDKK")]
    got = sorted(rows_of(repair.apply_edits(df, audits)), key=lambda r: r["place"])
    assert [(r["role"], r["text"]) for r in got] == [("system", "s."), ("user", "v."), ("assistant", "a.")]
