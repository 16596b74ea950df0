"""Conversation structure repair by dynamic programming over a grammar.

Every message is one of nine symbols: its role's kind and its fault. Re-Pair turns frequent pairs of
symbols into rules, counted over all conversations. A symbol's transfer matrix says, for every state
of the expected order before and after it, the least cost and, as a rope, the least list of edits
that has it; a rule's matrix is the min-plus product of its two parts, made once and shared by
all conversations. A conversation is then a product of the few matrices it was compressed to.

Conversations are cut into segments along their order, over as many tasks as their rows need; those
of several segments are put together from the segments' matrices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import partitions, stored

# Costs of the edits, and of leaving a truncated message.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Messages of a segment at most, and about how many characters of text.
SEGMENT, SEGMENT_CHARS = 2048, 1 << 20
#: Rules made in a round, rounds, and how often a pair occurs at least to become one.
RULES, ROUNDS, LEAST = 16, 6, 8
#: Results of compressed segments that a task remembers.
MEMORY = 20_000

_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_KINDS = "suax"
#: Symbols: 2 * kind + truncated for kinds s, u, a and others; then messages that must go.
GONE, TERMINALS = 8, 9
#: States: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
_LEGAL = {"su", "ua", "au"}


class Rope:
    """Edits as a tree of shared parts."""

    __slots__ = ("left", "right", "size")

    def __init__(self, left: Rope | str, right: Rope | None = None) -> None:
        self.left, self.right = left, right
        self.size = len(left) if right is None else left.size + right.size

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.right is None:
                out.append(x.left)
            else:
                todo += (x.right, x.left)
        return "".join(out)

    def __reduce__(self) -> tuple:
        return Rope, (self.left, self.right)


_NOTHING = Rope("")
Cell = tuple[int, Rope]
#: Cells by (state before, state after); those that can't be are left out.
Matrix = dict[tuple[int, int], Cell]


def _before(a: Rope, b: Rope) -> bool:
    """Whether a's edits come first by bytes. What both begin with in common is not looked at."""
    ends_a, ends_b = [], []
    while a is not b and (a.right is not None or b.right is not None):
        if b.right is None or (a.right is not None and a.size >= b.size):
            ends_a.append(a.right)
            a = a.left
        else:
            ends_b.append(b.right)
            b = b.left
    heads = ("", "") if a is b else (str(a), str(b))
    return heads[0] + "".join(map(str, reversed(ends_a))) < heads[1] + "".join(map(str, reversed(ends_b)))


def _better(new: Cell, old: Cell | None) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and new[1] is not old[1] and _before(new[1], old[1]))


def product(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus: the least way through both. Of two ways of equal cost between the same states over the
    same messages neither begins with the other (it would cost an insertion more), so the least
    way is made of least ways."""
    out: Matrix = {}
    for (i, k), x in a.items():
        for (k2, j), y in b.items():
            if k == k2:
                cell = (x[0] + y[0], Rope(x[1], y[1]) if x[1].size and y[1].size else (x[1] if x[1].size else y[1]))
                if _better(cell, out.get((i, j))):
                    out[i, j] = cell
    return out


def _insertions() -> dict[tuple[int, int], int]:
    """Messages to insert from a state to another."""
    step = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
    out = {}
    for i in range(4):
        at = i
        for k in range(3):
            out.setdefault((i, at), k)
            at = step[at]
    return out


INSERTIONS = _insertions()
#: What may still be inserted at the end, so that nothing or whole exchanges are left.
FINAL = {i: min(k for (a, j), k in INSERTIONS.items() if a == i and j in (START, ASSISTANT)) for i in range(4)}


def terminal(symbol: int) -> Matrix:
    """Insertions, then one edit of the message."""
    out: Matrix = {}
    kind, truncated = (None, 0) if symbol == GONE else (_KINDS[symbol // 2], symbol % 2)
    for (i, k), n in INSERTIONS.items():
        ways = [(DELETE, "D", k)]
        if kind is not None:
            stay = truncated * TRUNCATED
            follow = {"s": {START: SYSTEM}, "u": dict.fromkeys((START, SYSTEM, ASSISTANT), USER), "a": {USER: ASSISTANT}}
            if k in follow.get(kind, {}):
                ways.append((KEEP + stay, "K", follow[kind][k]))
            ways.append((REROLE + stay, "R", ASSISTANT if k == USER else USER))
        for cost, edit, j in ways:
            cell = (INSERT * n + cost, Rope("I" * n + edit))
            if _better(cell, out.get((i, j))):
                out[i, j] = cell
    return out


def matrices(rules: list[tuple[int, int]]) -> list[Matrix]:
    """One for each symbol, bottom-up: rules are made of earlier symbols."""
    made = [terminal(s) for s in range(TERMINALS)]
    for a, b in rules:
        made.append(product(made[a], made[b]))
    return made


def through(row: dict[int, Cell], symbols: list[int], made: list[Matrix]) -> dict[int, Cell]:
    """The least ways of a row of states on through a sequence."""
    for s in symbols:
        out: dict[int, Cell] = {}
        for (i, j), (cost, rope) in made[s].items():
            if i in row:
                before = row[i]
                cell = (before[0] + cost, Rope(before[1], rope))
                if _better(cell, out.get(j)):
                    out[j] = cell
        row = out
    return row


def ended(row: dict[int, Cell]) -> Cell:
    """The least way to an allowed end."""
    best: Cell | None = None
    for i, (cost, rope) in sorted(row.items()):
        cell = (cost + INSERT * FINAL[i], Rope(rope, Rope("I" * FINAL[i])) if FINAL[i] else rope)
        if _better(cell, best):
            best = cell
    return best


def replaced(x: np.ndarray, rules: list[tuple[int, int]]) -> np.ndarray:
    """The sequence with all rules applied in their order, from left to right."""
    for k, (a, b) in enumerate(rules):
        at = np.flatnonzero((x[:-1] == a) & (x[1:] == b))
        if a == b and len(at):
            run = np.cumsum(np.r_[True, np.diff(at) > 1]) - 1
            at = at[(at - at[np.searchsorted(run, run)]) % 2 == 0]
        if len(at):
            x = x.copy()
            x[at] = TERMINALS + k
            x = np.delete(x, at + 1)
    return x


_GAP = np.int64(-1)


def grammar(segments: DataFrame, rounds: int = ROUNDS, each: int = RULES, least: int = LEAST) -> list[tuple[int, int]]:
    """Re-Pair over all segments (column symbols): in each round the most frequent pairs become rules. At most rounds * each of them come to the driver."""
    rules: list[tuple[int, int]] = []
    for _ in range(rounds):
        known = list(rules)

        def counted(batches: Iterator[pa.RecordBatch], known: list[tuple[int, int]] = known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts = [np.r_[np.frombuffer(s, np.uint8).astype(np.int64), _GAP] for s in batch.column("symbols").to_pylist() if s]
                x = replaced(np.concatenate(parts), known) if parts else np.zeros(0, np.int64)
                pairs = (x[:-1] << 20 | x[1:])[(x[:-1] != _GAP) & (x[1:] != _GAP)]
                unique, n = np.unique(pairs, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(unique), pa.array(n)], names=["pair", "n"])

        counts = segments.select("symbols").mapInArrow(counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        best = [r["pair"] for r in counts.orderBy(F.desc("n"), "pair").limit(each).collect()]
        if not best:
            break
        rules += [(p >> 20, p & ((1 << 20) - 1)) for p in best]
    return rules


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: every twentieth row each is dropped, emptied, cut off, doubled or set to user.

    Null roles and texts are one space, as are null ids and turns in the checksum's text.
    """
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    said = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), some("role").alias("role"), some("text").alias("text"))
    harm = F.crc32(F.concat(some("conv_id"), F.lit(":"), some("turn")).cast("binary")) % 20
    return said.withColumn("harm", harm).where("harm <> 0").select(
        "conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("harm") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _same(*pairs: tuple[Column, Column]) -> Column:
    out = F.lit(True)
    for a, b in pairs:
        out &= a.eqNullSafe(b)
    return out


_SEGMENT = (
    "conv_id long, part int, place int, whole boolean, symbols binary, roles array<string>, texts array<string>, first_turn long, last_turn long,"
    " turns long, rows long, blank long, duplicate long, truncated long, illegal long, first string, last string"
)


def segments(rows: DataFrame, most: int = SEGMENT) -> DataFrame:
    """Messages (conv_id, turn, role, text, copies) as segments, in order by (conv_id, part, place).

    Equal messages are put together first, so that any number of them is one row. Then all are
    ranged by conversation and turn, so that a long conversation lies in several tasks, and read in order.
    """
    some = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    turn = F.struct(F.col("turn").isNotNull().alias("there"), F.col("turn").alias("turn"))
    some = some.withColumn("digest", F.md5("text"))
    seen = some.groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("first_seen"), F.count("*").alias("n")).where("n > 1").alias("b")
    joined = some.alias("a").join(seen, _same(*[(F.col(f"a.{c}"), F.col(f"b.{c}")) for c in ("conv_id", "role", "digest")]), "left")
    bare = F.rtrim(F.col("a.text"), F.lit(_SPACE))
    fault = F.when(bare == "", "b").when(turn > F.col("first_seen"), "d").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "t").otherwise("")
    again = F.when(bare == "", "b").otherwise("d")
    ready = joined.select("a.conv_id", "a.turn", "a.role", "a.text", "copies", fault.alias("fault"), again.alias("again"))
    # Ranges by the beginning of a text: what bounds them stays small.
    ranged = ready.repartitionByRange(partitions(rows.sparkSession), "conv_id", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions("conv_id", "turn", "role", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        places, now, first, out = 0, None, True, []

        def close(conv: int | None, whole: bool) -> None:
            nonlocal now, places
            s, places = now, places + 1
            now = None
            out.append((conv, part, places - 1, whole, bytes(s["symbols"]), s["roles"], s["texts"], s["first_turn"], s["last_turn"], s["turns"], len(s["symbols"]), s["b"], s["d"], s["t"], s["illegal"], s["first"], s["last"]))

        def opened() -> dict:
            return {"symbols": bytearray(), "roles": [], "texts": [], "chars": 0, "first_turn": None, "last_turn": None, "turns": 0, "b": 0, "d": 0, "t": 0, "illegal": 0, "first": None, "last": None}

        def add(conv: int | None, turn: int | None, role: str, text: str, fault: str) -> bool:
            """Whether the conversation had to be cut here."""
            nonlocal now
            full = now is not None and (len(now["symbols"]) >= most or now["chars"] >= SEGMENT_CHARS)
            if full:
                close(conv, False)
            if now is None:
                now = opened()
            s = now
            initial = role[:1]
            if turn is not None:
                s["turns"] += turn != s["last_turn"]
                s["first_turn"] = turn if s["first_turn"] is None else s["first_turn"]
                s["last_turn"] = turn
            if s["first"] is None:
                s["first"] = initial
            elif s["last"] + initial not in _LEGAL:
                s["illegal"] += 1
            s["last"] = initial
            if fault:
                s[fault] += 1
            gone = fault in ("b", "d")
            kind = _KINDS.find(initial) if initial in ("s", "u", "a") else 3
            s["symbols"].append(GONE if gone else 2 * kind + (fault == "t"))
            s["roles"].append("" if gone else role)
            s["texts"].append("" if gone else text)
            s["chars"] += len(s["texts"][-1])
            return full

        def sent() -> pa.RecordBatch:
            names = [c.split()[0] for c in _SEGMENT.split(",")]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), *[pa.int64()] * 8, pa.string(), pa.string()]
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        conv, split = None, True
        for batch in batches:
            for c, turn, role, text, copies, fault, again in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "turn", "role", "text", "copies", "fault", "again")), strict=True):
                if first or c != conv:
                    # What a task sees first may have begun in another one.
                    if not first:
                        close(conv, not split)
                    conv, split, first = c, first, False
                split |= add(c, turn, role, text, fault)
                for _ in range(copies - 1):
                    split |= add(c, turn, role, text, again)
                    if len(out) >= 64:
                        yield sent()
                if len(out) >= 64:
                    yield sent()
        if now is not None:
            close(conv, False)
        if out:
            yield sent()

    return stored(ranged.mapInArrow(cut, _SEGMENT), "segments")


def edited(symbols: bytes, roles: list[str], texts: list[str], audit: str, state: int) -> list[tuple[str, str]]:
    """The messages (role, text) that a segment's edits leave, from a state on."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K" and roles[at][:1] == "s":
            state = SYSTEM
        else:
            state = ASSISTANT if state == USER else USER
        role = roles[at] if edit == "K" else "assistant" if state == ASSISTANT else "user"
        out.append((role, "" if edit == "I" else texts[at]))
        at += edit != "I"
    return out


_TURNS = "array<struct<role:string,text:string>>"
_ARROW_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_SUMMED = ("blank", "duplicate", "truncated", "illegal")


def _as_turns(found: list[list[tuple[str, str]]]) -> pa.Array:
    return pa.array([[{"role": r, "text": t} for r, t in x] for x in found], _ARROW_TURNS)


def repaired(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From segments(): conversations (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), and
    what is left of their messages: (conv_id, part, place, whole, turns), turns being of one segment.

    whole says that a conversation is one segment. A conversation's edits are one string, so the
    task that puts a conversation together holds that; never its texts.
    """
    rules = grammar(parts)
    made = parts.sparkSession.sparkContext.broadcast(matrices(rules))  # at most ROUNDS * RULES of 16 cells
    figures = ["first_turn", "last_turn", "turns", *_SUMMED, "first", "last"]

    def compressed(symbols: bytes) -> list[int]:
        return replaced(np.frombuffer(symbols, np.uint8).astype(np.int64), rules).tolist()

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, str]] = {}
        for batch in batches:
            costs, audits, left = [], [], []
            for symbols, roles, texts in zip(*(batch.column(c).to_pylist() for c in ("symbols", "roles", "texts")), strict=True):
                if (got := known.get(symbols)) is None:
                    cost, rope = ended(through({START: (0, _NOTHING)}, compressed(symbols), made.value))
                    got = cost, str(rope)
                    if len(known) < MEMORY:
                        known[symbols] = got
                costs.append(got[0])
                audits.append(got[1])
                left.append(edited(symbols, roles, texts, got[1], START))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("conv_id", "part", "place", "first_turn", "last_turn", "turns", *_SUMMED)], pa.array(costs, pa.int64()), pa.array(audits, pa.string()), _as_turns(left)], names=["conv_id", "part", "place", "first_turn", "last_turn", "distinct", *_SUMMED, "cost", "audit", "left"])

    sums = "".join(f"{c} long, " for c in _SUMMED)
    one = stored(parts.where("whole").mapInArrow(single, f"conv_id long, part int, place int, first_turn long, last_turn long, distinct long, {sums}cost long, audit string, left {_TURNS}"), "repaired")

    def crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for symbols in batch.column("symbols").to_pylist():
                small = compressed(symbols)
                rows = {i: through({i: (0, _NOTHING)}, small, made.value) for i in range(4)}
                cells.append([{"i": i, "j": j, "cost": c, "audit": str(r)} for i, row in rows.items() for j, (c, r) in row.items()])
            kind = pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("conv_id", "part", "place", *figures)], pa.array(cells, kind)], names=["conv_id", "part", "place", *figures, "cells"])

    texts = parts.where("NOT whole")
    crossed = texts.mapInArrow(crossing, "conv_id long, part int, place int, " + "".join(f"{c} {'string' if c in ('first', 'last') else 'long'}, " for c in figures) + "cells array<struct<i:int,j:int,cost:long,audit:string>>")
    crossed = crossed.repartition(partitions(parts.sparkSession), "conv_id").sortWithinPartitions("conv_id", "part", "place")

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams over sorted segments; a row for each of them, the last of a conversation with its figures."""
        conv, row, places, sums, out = None, None, [], None, []

        def close() -> None:
            finish = ended(row)
            # The way back: the rope's leaves are the segments' edits, and the insertions at the end.
            leaves, todo = [], [finish[1]]
            while todo:
                x = todo.pop()
                if x.right is None:
                    leaves.append(x.left)
                else:
                    todo += (x.right, x.left)
            leaves = [x for x in leaves if x]
            if len(leaves) > len(places):
                leaves[len(places) - 1 :] = ["".join(leaves[len(places) - 1 :])]
            for k, ((part, place, ways), edits) in enumerate(zip(places, leaves, strict=True)):
                state = START if not k else after
                after = ways[state, edits] if (state, edits) in ways else -1
                last = k == len(places) - 1
                out.append((conv, part, place, state, edits, last, *([sums["first_turn"], sums["last_turn"], sums["turns"], *[sums[c] for c in _SUMMED], finish[0], str(finish[1])] if last else [None] * 9)))

        def sent() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), *[pa.int64()] * 8, pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "part", "place", "state", "edits", "ends", "first_turn", "last_turn", "distinct", *_SUMMED, "cost", "audit"])

        for batch in batches:
            for got in batch.to_pylist():
                if row is None or got["conv_id"] != conv:
                    if row is not None:
                        close()
                    conv, row, places, sums = got["conv_id"], {START: (0, _NOTHING)}, [], None
                matrix = {(c["i"], c["j"]): (c["cost"], Rope(c["audit"])) for c in got["cells"]}
                row = through(row, [0], [matrix])
                places.append((got["part"], got["place"], {(c["i"], c["audit"]): c["j"] for c in got["cells"]}))
                if sums is None:
                    sums = got
                else:
                    merged = {c: sums[c] + got[c] for c in _SUMMED}
                    merged["illegal"] += sums["last"] + got["first"] not in _LEGAL
                    met = got["first_turn"] is not None and got["first_turn"] == sums["last_turn"]
                    merged["turns"] = sums["turns"] + got["turns"] - met
                    merged["first_turn"] = got["first_turn"] if sums["first_turn"] is None else sums["first_turn"]
                    merged["last_turn"] = sums["last_turn"] if got["last_turn"] is None else got["last_turn"]
                    sums = {**merged, "first": sums["first"], "last": got["last"]}
            if out:
                yield sent()
        if row is not None:
            close()
        if out:
            yield sent()

    put = stored(crossed.mapInArrow(folded, f"conv_id long, part int, place int, state int, edits string, ends boolean, first_turn long, last_turn long, distinct long, {sums}cost long, audit string"), "edits")
    figured = ["conv_id", "first_turn", "last_turn", "distinct", *_SUMMED, "cost", "audit"]
    found = one.select(*figured).unionByName(put.where("ends").select(*figured))
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("distinct"), F.lit(0)).alias("gaps")

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [edited(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("symbols", "roles", "texts", "edits", "state")), strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("conv_id", "part", "place")], _as_turns(left)], names=["conv_id", "part", "place", "left"])

    rest = texts.select("conv_id", "part", "place", "symbols", "roles", "texts").join(put.select("part", "place", "state", "edits"), ["part", "place"])
    rest = rest.mapInArrow(applied, f"conv_id long, part int, place int, left {_TURNS}")
    turns = one.select("conv_id", "part", "place", F.lit(True).alias("whole"), F.col("left").alias("turns"))
    turns = turns.unionByName(rest.select("conv_id", "part", "place", F.lit(False).alias("whole"), F.col("left").alias("turns")))
    return found.select("conv_id", gaps, *_SUMMED, "cost", "audit"), turns


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the messages left, as lines ``role:text``; long conversations are read in order, a segment at a time."""
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = turns.where("whole").select("conv_id", F.sha2(line, 256).alias("repaired_sha256"))
    rest = turns.where("NOT whole").where(F.size("turns") > 0).select("conv_id", "part", "place", line.alias("lines"))
    rest = rest.repartition(partitions(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "part", "place")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            ids, sums = [], []
            for c, lines in zip(batch.column("conv_id").to_pylist(), batch.column("lines").to_pylist(), strict=True):
                if state is None or c != conv:
                    if state is not None:
                        ids.append(conv)
                        sums.append(state.hexdigest())
                    conv, state = c, hashlib.sha256(lines.encode())
                else:
                    state.update(b"\n" + lines.encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sums, pa.string())], names=["conv_id", "repaired_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([state.hexdigest()])], names=["conv_id", "repaired_sha256"])

    return whole.unionByName(rest.mapInArrow(hashed, "conv_id long, repaired_sha256 string"))
