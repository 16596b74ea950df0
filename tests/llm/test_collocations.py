"""Phrase mining against counting everything."""

import random
import re
from collections import Counter, defaultdict

import pytest

from gaugeline.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted_all(rows, top, least=collocations.LEAST):
    """Every phrase's count, score and cover, with nothing pruned."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in candidates.items():
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            longer = [q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * candidates[q] >= 80 * a for q in longer):
                rows_.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, r, p.decode(), -a, le, ri, n[lang], -s) for r, (s, a, p, le, ri) in enumerate(sorted(rows_)[:top], 1)]
    return sorted(out)


def made(seed):
    rng = random.Random(seed)
    words = ["the", "Of", "é", "x-1", "new", "york", "city", "hall", " a", "b\x1cc"]
    rows = []
    for k in range(400):
        said = [rng.choice(words) for _ in range(rng.randrange(0, 30))]
        if k % 3 == 0:
            at = rng.randrange(len(said) + 1)
            said[at:at] = rng.choice([["New", "York", "City", "Hall"], ["q1", "q2", "q3"], ["p1", "p2"], ["same"] * 6])
        rows.append((rng.choice(["en", "de", None, "und"]), "".join(w + rng.choice([" ", " ", " ", "\t", ". ", ",", "\x0b", "  "]) for w in said)))
    rows += [("en", None), ("fr", ""), (None, None), ("fr", "one two"), ("en", "Q8 Q9 " * 3000)] + rows[:30]
    return rows


@pytest.mark.parametrize(("top", "slack", "seed"), [(2000, 2, 1), (5, 1, 2), (12, 1, 3)])
def test_equals_counting_everything(spark, top, slack, seed):
    rows = made(seed)
    # Columns named like the operator's own are left alone.
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "lang string, text string, code long, n long")
    got = collocations.mined(df, top, slack)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == counted_all(rows, top)


def test_pruning_leaves_prefixes_out(spark):
    """With few phrases asked for, most trigrams are never counted, and the result is the same."""
    rng = random.Random(9)
    pieces = [" ".join(rng.choice("abcdefgh") for _ in range(60)) for _ in range(300)] + ["alpha beta gamma"] * 60 + ["delta epsilon"] * 90
    df = spark.createDataFrame([("en", p) for p in pieces], "lang string, text string")
    seen = []
    counting = collocations.count_phrases

    def watched(rows, length, wanted):
        got = counting(rows, length, wanted)
        seen.append((length, got.count()))
        return got

    collocations.count_phrases = watched
    try:
        got = collocations.mined(df, 2, 1)
        assert sorted(tuple(r) for r in got.collect()) == counted_all([("en", p) for p in pieces], 2)
    finally:
        collocations.count_phrases = counting
    assert max(n for k, n in seen if k == 2) > 50 > max(n for k, n in seen if k == 3)


def test_empty_table(spark):
    assert collocations.mined(spark.createDataFrame([], "lang string, text string")).count() == 0
