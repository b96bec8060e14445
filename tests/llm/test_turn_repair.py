"""Repair of conversations against a plain search over all edits."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweir.llm import turn_repair
from clickweir.llm.catalog import QUERIES

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def plain(conv, rows):
    """Row of one conversation; `rows` are (turn, role, text) in order. Keeps the best edits for each string of initials' end."""
    faults, seen = [], set()
    for turn, role, text in rows:
        solid = SOLID.findall(text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)

    def state(written):      # all that the language remembers of what was written
        return written if len(written) < 2 else written[0] if written == "s" else "~" + written[-1]

    def inserts(best):
        todo = list(best.items())
        while todo:
            (_, (cost, audit, written, lines)) = todo.pop()
            for role in ("user", "assistant"):
                new = (cost + 2, audit + "I", written + role[0], [*lines, role + ":"])
                if fits(new[2]) and (state(new[2]) not in best or new[:2] < best[state(new[2])][:2]):
                    best[state(new[2])] = new
                    todo.append((state(new[2]), new))
        return best

    def fits(written):
        return re.fullmatch("s?(ua)*u?", written) is not None

    best = inserts({"": (0, "", "", [])})
    for (turn, role, text), fault in zip(rows, faults):
        new = {}
        for cost, audit, written, lines in best.values():
            options = [(cost + 3, audit + "D", written, lines)]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                options.append((cost + more, audit + "K", written + (role[:1] or "?"), [*lines, role + ":" + text]))
                options += [(cost + 2 + more, audit + "R", written + r[0], [*lines, r + ":" + text]) for r in ("user", "assistant")]
            for o in options:
                if fits(o[2]) and (state(o[2]) not in new or o[:2] < new[state(o[2])][:2]):
                    new[state(o[2])] = o
        best = inserts(new)
    cost, audit, _, lines = min((b for b in best.values() if re.fullmatch("(s?(ua)+)?", b[2])), key=lambda b: b[:2])
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def order(r):
    return (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())


def plain_damage(rows):
    by = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        some = by.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        some += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return [plain(conv, [r[1:] for r in sorted(some, key=order)]) for conv, some in by.items()]


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_blocks_of_symbols_are_single_steps(seed):
    t = turn_repair.tables()
    symbols = np.array(random.Random(seed).choices(range(9), k=30 + seed))
    now, cost = np.arange(len(t.vectors)), 0
    for s in symbols[::-1]:
        cost = cost + t.step_cost[now, s]
        now = t.step[now, s]
    front, low = turn_repair.vectors_before(t, symbols)
    assert (front == now).all() and (low == cost).all() and len(t.vectors) < 100


def test_traces_against_plain_search():
    rng, t = random.Random(5), turn_repair.tables()
    kinds = [(r, x) for r in ("system", "user", "assistant", "tool", "") for x in ("a.", "b", "  ")]
    runs = [list(x) for n in range(4) for x in itertools.product(kinds, repeat=n)] + [rng.choices(kinds, k=rng.randint(4, 40)) for _ in range(300)]
    for run in runs:
        rows = [(i, role, text + (f" {i}." if text.strip() and text[-1] == "." else f" {i}" if text.strip() and rng.random() < 0.8 else ""))
                for i, (role, text) in enumerate(run)]
        seen, symbols = set(), []
        for _, role, text in rows:
            symbols.append(turn_repair.symbol_of(role, text, (role, text) in seen)[0])
            seen.add((role, text))
        expected = plain(0, rows)
        edits, state = turn_repair.trace(t, np.array(symbols, int), 0, turn_repair.START)
        front, low = turn_repair.vectors_before(t, np.array(symbols, int))
        assert "".join(edits) + t.ends[state][0] == expected[7]
        assert t.vectors[front[0]][turn_repair.START] + low[0] + t.base == expected[6]


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op12_turn_repair"](spark, sf)
    assert sorted(df.columns) == sorted(COLUMNS) and got(df) == sorted(plain_damage(rows), key=str)


ODD = ([(1, None, "user", "no turn."), (1, None, None, None), (1, 3, "assistant", "Yes! \t\n"), (1, 3, "assistant", "Yes! \t\n"), (1, 900, "user", "x" * 5000)]
       + [(None, t, r, f"text {t}.") for t, r in enumerate(["user", "assistant", "tool", "sysop"])] + [(2, None, None, None)]
       + [(3, 7, "user", "same.")] * 9 + [(4, 0, "a", ""), (4, 1, "", "?"), (4, 2, "ümlaut", "。")])


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, 1, 2) for r in ODD], "conv_id bigint, turn bigint, role string, text string, cost int, part int").repartition(5)
    assert got(turn_repair.report(turn_repair.repair(*turn_repair.damaged(df)))) == sorted(plain_damage(ODD), key=str)
    kept = turn_repair.report(turn_repair.repair(df))
    by = {}
    for c, t, r, x in ODD:
        by.setdefault(c, []).append((c, t, " " if r is None else r, " " if x is None else x))
    assert got(kept) == sorted((plain(c, [r[1:] for r in sorted(rows, key=order)]) for c, rows in by.items()), key=str)
    assert turn_repair.report(turn_repair.repair(df.limit(0))).collect() == []


def test_hot_conversation_over_many_chunks(spark):
    rng = random.Random(3)
    hot = [(5, t // 2 if t % 3 else None, rng.choice(["user", "assistant", "tool"]), rng.choice(["Yes.", "No", " ", f"{t}.", f"{t}"])) for t in range(9000)]
    rows = hot + [(9, 1, "user", "again.")] * 5000 + [(c, t, "user", f"{t}.") for c in (4, 6) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    chunks = turn_repair.chunked(df).groupBy("conv_id").count().collect()
    assert max(r["count"] for r in chunks) > 4
    pieces = turn_repair.repair(df)
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert got(turn_repair.report(pieces)) == sorted((plain(c, [r[1:] for r in sorted(some, key=order)]) for c, some in by.items()), key=str)
    repaired = turn_repair.messages(pieces).filter(F.col("conv_id") == 5).orderBy("part", "chunk", "place").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in repaired))
