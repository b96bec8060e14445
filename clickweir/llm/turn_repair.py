"""Repair of the order of roles in conversations at the least cost, by block tables.

A row is one of nine symbols: its role's initial (s, u, a or another), whole or cut off, or a row that must go. The cost to
finish, from each of the four states of the language (s?(ua)+)?, is a vector; less its smallest entry it is one of
a few dozen (`Tables`). So what a block of symbols does to such a vector is precomputed for every block and vector:
the vector before the block, and what is added. A conversation goes from its end to its start by a
lookup for each block. Every block is then expanded backward symbol by symbol from the vector behind it, and the edits are
read off forward, always the ASCII-least that the costs allow; each choice leads to one state, so ties are exact.

Rows are sorted by ranges, cut into chunks of bounded size, and a conversation of many chunks is never in one
task: chunks say, for every vector behind them, the vector before them; small rows carry those from end
to start, and states from start to end; then all chunks are traced at once. Only the final digest goes through a
conversation's pieces in a row, as SHA-256 does, without holding them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickweir.llm.workers import releasing, ship_package
from clickweir.session import stored

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1      # costs of the edits, and of a cut-off row that stays
BLOCK = 4                # symbols of a block
CHUNK_ROWS = 2048        # rows and characters of a chunk
CHUNK_CHARS = 1 << 20
WHITE = " \t\n\x0b\x0c\r"
INITIALS = "sua"
MUST_GO = 8              # symbols: 2 * (place in INITIALS, or 3) + cut off; and a row that must go
SYMBOLS = 9
START, AFTER_S, AFTER_U, AFTER_A = range(4)
# state -> the role that may be written there, and the state behind it
WRITES = {START: ("user", AFTER_U), AFTER_S: ("user", AFTER_U), AFTER_U: ("assistant", AFTER_A), AFTER_A: ("user", AFTER_U)}
# (state, initial) -> state behind a row that is kept
KEPT = {(START, 0): AFTER_S, (START, 1): AFTER_U, (AFTER_S, 1): AFTER_U, (AFTER_U, 2): AFTER_A, (AFTER_A, 1): AFTER_U}
# letters of the edits, in ASCII order
D, I, K, R = "DIKR"


def closed(costs: list[int]) -> tuple[int, ...]:
    """Costs to finish when rows may be inserted first."""
    costs = list(costs)
    for _ in range(2):
        for state, (_, then) in WRITES.items():
            costs[state] = min(costs[state], INSERT + costs[then])
    return tuple(costs)


def row_options(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state behind) of the edits that take the row."""
    out = [(D, DELETE, state)]
    if symbol != MUST_GO:
        cut = CUT_OFF * (symbol & 1)
        if (state, symbol >> 1) in KEPT:
            out.append((K, KEEP + cut, KEPT[state, symbol >> 1]))
        out.append((R, REROLE + cut, WRITES[state][1]))
    return out


def before(symbol: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to finish in front of a row, from those behind it."""
    return closed([min(cost + behind[then] for _, cost, then in row_options(symbol, state)) for state in range(4)])


@dataclass
class Tables:
    """Normalised vectors by number, number 0 at a conversation's end; what symbols and blocks of them do."""

    vectors: list[tuple[int, ...]] = field(default_factory=list)
    base: int = 0                 # what was taken off the vector at the end
    step: np.ndarray = None       # [vector, symbol] -> vector in front
    step_cost: np.ndarray = None  # and what is taken off it
    block: np.ndarray = None      # the same for [vector, block], the last symbol of a block being its lowest digit
    block_cost: np.ndarray = None
    moves: list = None            # [vector behind][symbol][state] -> letters, inserts first, and the state behind
    ends: list = None             # [state] -> inserts at the end


@lru_cache(maxsize=2)
def tables(block: int = BLOCK) -> Tables:
    t = Tables()
    end = closed([0, 1 << 20, 1 << 20, 0])
    t.base = min(end)
    number = {tuple(c - t.base for c in end): 0}
    t.vectors = list(number)
    steps: list[list[tuple[int, int]]] = []
    for v in t.vectors:                       # grows while new ones are found
        row = []
        for symbol in range(SYMBOLS):
            new = before(symbol, v)
            low = min(new)
            new = tuple(c - low for c in new)
            if new not in number:
                number[new] = len(t.vectors)
                t.vectors.append(new)
            row.append((number[new], low))
        steps.append(row)
    both = np.array(steps, "i8")
    t.step, t.step_cost = both[..., 0], both[..., 1]
    code = np.arange(SYMBOLS ** block)
    t.block = np.repeat(np.arange(len(t.vectors))[:, None], len(code), 1)
    t.block_cost = np.zeros_like(t.block)
    for _ in range(block):                    # from the last symbol of the block to its first
        symbol, code = code % SYMBOLS, code // SYMBOLS
        t.block_cost = t.block_cost + t.step_cost[t.block, symbol]
        t.block = t.step[t.block, symbol]

    def letters(behind: tuple[int, ...], symbol: int, state: int) -> tuple[str, int]:
        """ASCII-least edits up to and with the row, of least cost."""
        here, made = before(symbol, behind), ""
        while True:
            fits = {letter: then for letter, cost, then in row_options(symbol, state) if cost + behind[then] == here[state]}
            if D in fits:
                return made + D, fits[D]
            if INSERT + here[WRITES[state][1]] == here[state]:
                made, state = made + I, WRITES[state][1]
                continue
            letter = K if K in fits else R
            return made + letter, fits[letter]

    t.moves = [[[letters(v, symbol, state) for state in range(4)] for symbol in range(SYMBOLS)] for v in t.vectors]
    t.ends = [("", START), ("II", AFTER_A), ("I", AFTER_A), ("", AFTER_A)]
    return t


def vectors_before(t: Tables, symbols: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """For every vector behind a run of symbols: the vector in front, and the cost taken off on the way."""
    now = np.arange(len(t.vectors))
    cost = np.zeros(len(now), "i8")
    head = len(symbols) % block
    if len(symbols) > head:
        codes = symbols[head:].reshape(-1, block) @ (SYMBOLS ** np.arange(block - 1, -1, -1))
        for code in codes[::-1].tolist():
            cost += t.block_cost[now, code]
            now = t.block[now, code]
    for symbol in symbols[:head][::-1].tolist():
        cost += t.step_cost[now, symbol]
        now = t.step[now, symbol]
    return now, cost


def trace(t: Tables, symbols: np.ndarray, behind: int, state: int, block: int = BLOCK) -> tuple[list[str], int]:
    """Letters of every row, inserts before it included, and the state behind the last."""
    head = len(symbols) % block
    cuts = [0, *range(head, len(symbols), block)] if head else list(range(0, len(symbols), block))
    symbols_list = symbols.tolist()
    # the vector behind each block, by lookups from the end
    at_end = [0] * len(cuts)
    now = behind
    for k in range(len(cuts) - 1, -1, -1):
        at_end[k] = now
        stop = cuts[k + 1] if k + 1 < len(cuts) else len(symbols_list)
        part = symbols_list[cuts[k]:stop]
        if len(part) == block:
            code = 0
            for s in part:
                code = code * SYMBOLS + s
            now = int(t.block[now, code])
        else:
            for s in reversed(part):
                now = int(t.step[now, s])
    out = []
    for k, first in enumerate(cuts):
        stop = cuts[k + 1] if k + 1 < len(cuts) else len(symbols_list)
        inner = [at_end[k]]                   # the block, expanded backward
        for s in reversed(symbols_list[first + 1:stop]):
            inner.append(int(t.step[inner[-1], s]))
        for s in symbols_list[first:stop]:
            letters, state = t.moves[inner.pop()][s][state]
            out.append(letters)
    return out, state


def symbol_of(role: str, text: str, seen: bool) -> tuple[int, str | None]:
    """Symbol of a row and its first fault."""
    bare = text.rstrip(WHITE)
    if not bare:
        return MUST_GO, "blank"
    if seen:
        return MUST_GO, "duplicate"
    initial = INITIALS.find(role[:1]) if role else -1
    cut = bare[-1] not in ".!?"
    return 2 * (initial if initial >= 0 else 3) + cut, "truncated" if cut else None


# --- chunks ---

MESSAGE = "struct<turn: bigint, role: string, text: string, copies: bigint, digest: binary>"
CHUNK = f"part int, chunk int, conv_id bigint, alone boolean, messages array<{MESSAGE}>"


def _chunks(part: int, rows: Iterable[dict]) -> Iterator[dict]:
    """Runs of a conversation's rows from one sorted partition. `alone`: no other chunk can have rows of it."""
    made, first, held, size, chars, cut = 0, True, [], 0, 0, False
    conv: object = None

    def chunk(alone: bool) -> dict:
        nonlocal made
        made += 1
        return {"part": part, "chunk": made, "conv_id": conv, "alone": alone, "messages": held}

    for r in rows:
        if held and (r["conv_id"] != conv or size >= CHUNK_ROWS or chars >= CHUNK_CHARS):
            same = r["conv_id"] == conv
            yield chunk(not first and not cut and not same)
            first, cut, held, size, chars = first and same, same, [], 0, 0
        conv = r["conv_id"]
        digest = hashlib.sha256(b"%d:" % len(r["role"].encode()) + r["role"].encode() + r["text"].encode()).digest()
        held.append({"turn": r["turn"], "role": r["role"], "text": r["text"], "copies": r["copies"], "digest": digest})
        size += max(1, r["copies"])
        chars += len(r["role"]) + len(r["text"])
    if held:
        yield chunk(False)


def _batches(rows: Iterable[dict], schema: pa.Schema, most: int = 256, chars: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row.values() if isinstance(x, str | bytes)) + \
            sum(len(m.get("text") or "") for m in row.get("messages") or ())
        if len(held) >= most or size >= chars:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _map(df: DataFrame, fn, schema: str) -> DataFrame:
    arrow = _arrow(schema)
    return df.mapInArrow(releasing(lambda batches: _batches(fn(_rows(batches)), arrow)), schema)


def chunked(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """Chunks of conv_id, turn, role, text in the order of the rows; nulls of role and text are one space.

    `copies` is how often a row is there, 1 by default; a row that is there 0 times only names its
    conversation. Equal rows become one with the sum of their copies, before they are sorted.
    """
    from pyspark import TaskContext

    one = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("bigint").alias("copies"))
    order = ["conv_id", "turn", "role", "text"]
    total, share = F.sum("copies"), F.lit(CHUNK_ROWS)
    # a row of very many copies becomes one row for each chunk's worth
    shares = F.transform(F.sequence(F.lit(0).cast("bigint"), F.expr(f"greatest(total - 1, 0) div {CHUNK_ROWS}")),
                         lambda i: F.least(share, F.col("total") - i * share))
    merged = stored(one.groupBy(*order).agg(total.alias("total")).select(*order, F.explode(shares).alias("copies")), "turns")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = merged.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    arrow = _arrow(CHUNK)
    return stored(ranged.mapInArrow(releasing(
        lambda b: _batches(_chunks(TaskContext.get().partitionId(), _rows(b)), arrow)), CHUNK), "turn-chunks")


def _known(row: dict) -> tuple[np.ndarray, list[tuple[dict, str | None]]]:
    """Symbols of a chunk's rows, copies one by one, and the rows with their faults."""
    seen = set(row.get("seen") or ())
    symbols, out = [], []
    for m in row["messages"]:
        for _ in range(m["copies"]):
            symbol, fault = symbol_of(m["role"], m["text"], m["digest"] in seen)
            seen.add(m["digest"])
            symbols.append(symbol)
            out.append((m, fault))
    return np.array(symbols, "i8"), out


EDIT = "struct<turn: bigint, role: string, text: string, edit: string, fault: string>"
PIECE = (f"part int, chunk int, conv_id bigint, alone boolean, audit string, cost bigint, messages array<{EDIT}>, "
         "blank bigint, duplicate bigint, truncated bigint, illegal bigint, initials array<string>, turns array<bigint>")


def _allowed(left: str, right: str) -> bool:
    return left + right in ("su", "ua", "au")


def _traced(rows: Iterable[dict]) -> Iterator[dict]:
    """Chunks with the edits of their rows. `behind`: number of the vector behind the chunk, 0 at the end; `state`: in front
    of it; `last`: nothing follows, so that inserts at the end belong to it."""
    t = tables()
    for row in rows:
        symbols, found = _known(row)
        alone = row["alone"]
        behind, state, last = (0, START, True) if alone else (row["behind"], row["state"], row["last"])
        edits, state = trace(t, symbols, behind, state)
        messages, cost = [], 0
        position = START if alone else row["state"]

        def insert() -> None:
            nonlocal position, cost
            role, position = WRITES[position]
            messages.append({"turn": None, "role": role, "text": "", "edit": I, "fault": None})
            cost += INSERT

        for letters, symbol, (m, fault) in zip(edits, symbols.tolist(), found):
            for _ in letters[:-1]:
                insert()
            edit, role = letters[-1], m["role"]
            if edit == D:
                cost += DELETE
            else:
                cost += CUT_OFF * (fault == "truncated")
                if edit == R:
                    cost += REROLE
                    role, position = WRITES[position]
                else:
                    position = KEPT[position, symbol >> 1]
            messages.append({"turn": m["turn"], "role": role, "text": m["text"], "edit": edit, "fault": fault})
        audit = "".join(edits)
        if last:
            ends = t.ends[position][0]
            audit += ends
            for _ in ends:
                insert()
        initials = [m["role"][:1] for m, _ in found]
        numbers = [m["turn"] for m, _ in found if m["turn"] is not None]
        faults = [fault for _, fault in found]
        yield {"part": row["part"], "chunk": row["chunk"], "conv_id": row["conv_id"], "alone": alone, "audit": audit, "cost": cost,
               "messages": messages, "blank": faults.count("blank"), "duplicate": faults.count("duplicate"),
               "truncated": faults.count("truncated"),
               "illegal": sum(not _allowed(a, b) for a, b in zip(initials, initials[1:])),
               "initials": [initials[0], initials[-1]] if initials else [],
               "turns": [min(numbers), max(numbers), len(set(numbers))] if numbers else []}


def _summed(rows: Iterable[dict]) -> Iterator[dict]:
    """Of each chunk, the vector in front for every vector behind."""
    t = tables()
    for row in rows:
        symbols, _ = _known(row)
        yield {k: row[k] for k in ("part", "chunk", "conv_id")} | {"front": vectors_before(t, symbols)[0].tolist()}


def _carried_back(rows: Iterable[dict]) -> Iterator[dict]:
    """The vector behind each chunk; rows come from a conversation's end to its start."""
    conv, now, any_yet = None, 0, False
    for row in rows:
        if not any_yet or row["conv_id"] != conv:
            conv, now, last, any_yet = row["conv_id"], 0, True, True
        yield {k: row[k] for k in ("part", "chunk", "conv_id")} | {"behind": now, "last": last}
        now, last = row["front"][now], False


def _state_maps(rows: Iterable[dict]) -> Iterator[dict]:
    """Of each chunk, the state behind it for every state in front."""
    t = tables()
    for row in rows:
        symbols, _ = _known(row)
        then = [trace(t, symbols, row["behind"], state)[1] for state in range(4)]
        yield {k: row[k] for k in ("part", "chunk", "conv_id", "behind", "last")} | {"then": then}


def _carried_on(rows: Iterable[dict]) -> Iterator[dict]:
    """The state in front of each chunk; rows come from a conversation's start to its end."""
    conv, state, any_yet = None, START, False
    for row in rows:
        if not any_yet or row["conv_id"] != conv:
            conv, state, any_yet = row["conv_id"], START, True
        yield {k: row[k] for k in ("part", "chunk", "behind", "last")} | {"state": state}
        state = row["then"][state]


PLACE = "part int, chunk int, conv_id bigint"


def _in_turn(df: DataFrame, descending: bool = False) -> DataFrame:
    """Each conversation's rows in one task, in the order of its chunks."""
    by = [F.col(c).desc() if descending else F.col(c).asc() for c in ("part", "chunk")]
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *by)


def repair(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """Pieces of repaired conversations: conv_id, part and chunk (their order), `messages` with the edit and the
    fault of each (also the deleted ones), `audit`, the piece's cost and counts. `report` and `messages` read them.

    `rows` has conv_id, turn, role and text; other columns are not read. Rows stand in the order of turn (null first), then
    role and text. A null role or text is one space; a null conv_id is a conversation of its own. Repeated
    rows stand side by side, and all but the first must go. An empty table gives no pieces. Texts may be of any length.
    """
    ship_package(rows.sparkSession)
    chunks = chunked(rows, copies)
    whole = chunks.filter("alone")
    split = chunks.filter(~F.col("alone"))
    # what a conversation has had in an earlier chunk: one row per text and chunk, the first of all by place
    place = F.struct("part", "chunk")
    texts = (split.select(place.alias("place"), "conv_id", F.explode("messages").alias("m")).filter("m.copies > 0")
             .select("place", "conv_id", F.col("m.digest").alias("digest")).distinct())
    firsts = texts.groupBy("conv_id", "digest").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1") \
        .select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first")
    again = (texts.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")) & (F.col("first") < F.col("place")))
             .groupBy("place").agg(F.collect_list("digest").alias("seen"))      # a chunk's rows at most
             .select(F.col("place.part").alias("p"), F.col("place.chunk").alias("k"), "seen"))
    split = stored(split.join(again, (F.col("part") == F.col("p")) & (F.col("chunk") == F.col("k")), "left").drop("p", "k"), "turn-splits")

    front = _map(split, _summed, PLACE + ", front array<int>")
    behind = stored(_map(_in_turn(front, descending=True), _carried_back, PLACE + ", behind int, last boolean"), "turn-vectors")
    maps = _map(split.join(behind.drop("conv_id"), ["part", "chunk"]), _state_maps, PLACE + ", behind int, last boolean, then array<int>")
    states = stored(_map(_in_turn(maps), _carried_on, "part int, chunk int, behind int, last boolean, state int"), "turn-states")
    return _map(whole, _traced, PIECE).unionAll(_map(split.join(states, ["part", "chunk"]), _traced, PIECE))


def messages(pieces: DataFrame) -> DataFrame:
    """conv_id, part, chunk, place, turn, role, text, edit, fault: the rows that stay, in this order, and inserted ones."""
    return (pieces.select("conv_id", "part", "chunk", F.posexplode("messages").alias("place", "m"))
            .select("conv_id", "part", "chunk", "place", "m.*").filter(F.col("edit") != D))


REPORT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")


class _Report:
    """Figures of one conversation, piece by piece."""

    def __init__(self, conv_id):
        self.row = {"conv_id": conv_id, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0}
        self.digest, self.any, self.audit = hashlib.sha256(), False, []
        self.initial, self.low, self.high, self.distinct = None, None, None, 0

    def add(self, piece: dict) -> None:
        for k in ("blank", "duplicate", "truncated", "illegal", "cost"):
            self.row[k] += piece[k]
        self.audit.append(piece["audit"])
        for m in piece["messages"]:
            if m["edit"] != D:
                self.digest.update(("\n" * self.any + m["role"] + ":" + m["text"]).encode())
                self.any = True
        if piece["initials"]:
            if self.initial is not None:
                self.row["illegal"] += not _allowed(self.initial, piece["initials"][0])
            self.initial = piece["initials"][1]
        if piece["turns"]:
            low, high, n = piece["turns"]
            self.distinct += n - (low == self.high)     # pieces are in the order of turns
            self.low = low if self.low is None else self.low
            self.high = high

    def done(self) -> dict:
        if self.low is not None:
            self.row["gaps"] = self.high - self.low + 1 - self.distinct
        return self.row | {"audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}


def _reported(rows: Iterable[dict]) -> Iterator[dict]:
    report, conv = None, None
    for row in rows:
        if report is None or row["conv_id"] != conv or row["alone"]:
            if report is not None:
                yield report.done()
            report, conv = _Report(row["conv_id"]), row["conv_id"]
        report.add(row)
    if report is not None:
        yield report.done()


def report(pieces: DataFrame) -> DataFrame:
    """One row per conversation: gaps among its turns, rows by first fault, adjacent pairs of roles that are not allowed, the cost
    and letters of the edits, and the SHA-256 of the repaired `role:text` lines."""
    parts = stored(pieces, "turn-pieces")
    return _map(parts.filter("alone"), _reported, REPORT).unionAll(_map(_in_turn(parts.filter(~F.col("alone"))), _reported, REPORT))


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """The rows of `conversations` with planted damage, and how often each is there."""
    def space(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    out = rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(space("role")).alias("role"),
                      text.alias("text"), F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"))
    return out, F.col("copies")
