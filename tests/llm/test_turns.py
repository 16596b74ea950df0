"""Structure repair against a plain search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from gaugeline.llm import turns

SPACE = " \t\n\x0b\x0c\r"


def faults(rows):
    """(initial, fault) of rows (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def searched(marks):
    """(cost, audit): a shortest path over (rows used, state), ties by the audit."""
    done, todo = {}, [(0, "", 0, 0)]
    while todo:
        cost, audit, at, state = heapq.heappop(todo)
        if (at, state) in done:
            continue
        done[at, state] = cost, audit
        step = {0: 2, 1: 2, 2: 3, 3: 2}[state]
        heapq.heappush(todo, (cost + 3, audit + "I", at, step))
        if at < len(marks):
            initial, fault = marks[at]
            heapq.heappush(todo, (cost + 4, audit + "D", at + 1, state))
            if fault not in ("b", "d"):
                more = 3 * (fault == "t")
                heapq.heappush(todo, (cost + 3 + more, audit + "R", at + 1, step))
                keep = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((initial, state))
                if keep is not None:
                    heapq.heappush(todo, (cost + more, audit + "K", at + 1, keep))
    return min(done[len(marks), s] for s in (0, 3))


def applied(rows, audit):
    out, at = [], 0
    for e in audit:
        if e == "D":
            at += 1
            continue
        lead = bool(out) and out[0][0][:1] == "s" and audit.lstrip("D")[:1] == "K"
        role = rows[at][1] if e == "K" else ("user", "assistant")[(len(out) - lead) % 2]
        out.append((role, "" if e == "I" else rows[at][2]))
        at += e != "I"
    return out


def expected(rows):
    """conv_id -> all columns of the query, from rows (conv_id, turn, role, text)."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm = zlib.crc32(key.encode()) % 20
        if harm:
            one = (turn, "user" if harm == 4 else role, "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text)
            by[conv] += [one] * (2 if harm == 3 else 1)
    out = {}
    for conv, said in by.items():
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        marks = faults(said)
        cost, audit = searched(marks)
        there = [t for t, _, _ in said if t is not None]
        gaps = max(there) - min(there) + 1 - len(set(there)) if there else 0
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(marks, marks[1:], strict=False))
        lines = "\n".join(f"{r}:{t}" for r, t in applied(said, audit))
        out[conv] = (gaps, *[sum(f == k for _, f in marks) for k in "bdt"], illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())
    return out


def made(seed, convs=60, longest=40):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "ok!", "  ", "", None, "why?\n", "é…", "no.\x0b", "again and again.", "<\x85>"]
    roles = ["user", "assistant", "system", "tool", None, "", "u", "sys", "Assistant", "user", "assistant"]
    rows = []
    for c in range(convs):
        conv = None if c == 7 else c * 1001 - 3
        for t in range(rng.randrange(1, longest)):
            turn = rng.choice([t, t, t, t + rng.randrange(5), None])
            role = ("user", "assistant")[t % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.5 else f"line {t}" + rng.choice([".", "", "?"])))
        if c % 9 == 0:
            rows += [rows[-1]] * 5
    return rows + [(5, 1, "user", "again and again.")] * 40


def run(spark, rows, most):
    # A column named like the operator's own is left alone.
    df = spark.createDataFrame([(*r, 3) for r in rows], "conv_id long, turn long, role string, text string, copies int")
    found, left = turns.repaired(turns.segments(turns.damaged(df), most))
    sums = {r["conv_id"]: r["repaired_sha256"] for r in turns.digests(left).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    return {r["conv_id"]: (*[r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")], sums.get(r["conv_id"], nothing)) for r in found.collect()}


@pytest.mark.parametrize(("seed", "most"), [(1, 2048), (2, 3), (3, 1)])
def test_equals_a_search_over_all_edits(spark, seed, most):
    """Also with segments so short that every conversation is put together from several."""
    rows = made(seed)
    want = expected(rows)
    got = run(spark, rows, most)
    assert all(want[c] == got[c] for c in got) and all(w[6] == "" for c, w in want.items() if c not in got)


def test_empty_table(spark):
    assert run(spark, [], 10) == {}


def test_rules_change_nothing():
    """Matrices of rules, of any sequence, give what its messages give one by one."""
    rng = random.Random(4)
    rules = [(4, 2), (9, 9), (8, 8), (11, 8), (10, 3), (7, 9)]
    made_ = turns.matrices(rules)
    for _ in range(200):
        x = np.asarray([rng.randrange(turns.TERMINALS) if rng.random() < 0.5 else rng.choice([4, 2, 8]) for _ in range(rng.randrange(1, 40))], np.int64)
        small = turns.replaced(x, rules)
        back = small.tolist()
        for k in reversed(range(len(rules))):
            back = [y for s in back for y in (rules[k] if s == turns.TERMINALS + k else (s,))]
        assert back == x.tolist()
        marks = [("", "b") if s == turns.GONE else ("suax"[s // 2], "t" if s % 2 else "") for s in x.tolist()]
        for symbols in (small.tolist(), x.tolist()):
            cost, rope = turns.ended(turns.through({turns.START: (0, turns.Rope(""))}, symbols, made_))
            assert (cost, str(rope)) == searched(marks)


def test_frequent_pairs_become_rules(spark):
    df = spark.createDataFrame([(bytes([4, 2] * 20),)] * 50 + [(bytes([8] * 9),)] * 5 + [(b"",)], "symbols binary")
    rules = turns.grammar(df, rounds=3, each=2, least=2)
    assert rules[0] == (4, 2) and (8, 8) in rules and len(rules) <= 6
    assert len(turns.replaced(np.asarray([4, 2] * 20), rules)) <= 10
