"""Personal data: patterns against plain regular expressions, disclosure against counting everything."""

import random
import re
from collections import defaultdict

import pytest

from gaugeline.llm import disclosure

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == 1:
        return all(int(p) <= 255 for p in m.split("."))
    if kind == 2:
        checks = [int(c) if k % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for k, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(checks) % 10 == 0
    return kind == 0 or 8 <= len(digits) <= 15


def plain(text):
    return [(k, m.start(), m.end(), m.group()) for k, p in enumerate((EMAIL, IP, CARD, PHONE)) for m in re.finditer(p, text) if valid(k, m.group())]


def entity(kind, m):
    return kind, m.lower() if kind < 2 else re.sub("[^0-9]", "", m)


def test_patterns_find_what_plain_ones_find():
    rng = random.Random(5)
    bits = ["@", "@", "a", "b.c", ".", "..", "-", "_", "%", "+", "+1", " ", "(", ")", "1", "12", "255", "256", "0300", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (499) 555-6503", "10.0.0.1", "x@y.z", "é", "\n", "١", "00000000000000000000"]
    for _ in range(6000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(0, 25)))
        raw = text.encode()
        got = [(k, len(raw[:s].decode()), len(raw[:e].decode())) for k, s, e, _ in disclosure.base_spans(raw)]
        assert got == [(k, s, e) for k, s, e, _ in plain(text)], repr(text)
    # Long runs are read once.
    for part in ("a", "1", "@", "1.", "a@", "+1", "1 ", "a.b@"):
        disclosure.base_spans(part.encode() * 200_000)


def counted_all(texts, window, support, public):
    """The spans of every text, with all words and entities counted plainly."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = []
    for text in texts:
        base = plain(text)
        words = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(lower))]
        docs.append((base, words, [not any(s < e2 and e > s2 for _, s, e, _ in base) for s2, e2, _ in words]))
    terms = lambda w: {w, w[:4] + "*"} if len(w) > 4 else {w}
    n_term, holds, both = defaultdict(set), defaultdict(set), defaultdict(set)
    for i, (base, words, free) in enumerate(docs):
        for _, _, w in words:
            for t in terms(w):
                n_term[t].add(i)
        for k, s, e, m in base:
            holds[entity(k, m)].add(i)
            before = [j for j, w in enumerate(words) if w[1] <= s][-window:]
            after = [j for j, w in enumerate(words) if w[0] >= e][:window]
            for j in before + after:
                if free[j]:
                    for t in terms(words[j][2]):
                        both[entity(k, m), t].add(i)
    different = lambda ids: len({texts[i] for i in ids})
    strong = set()
    for (c, t), ids in both.items():
        if different(holds[c]) >= support and len(holds[c]) <= public * len(texts) and different(ids) >= support:
            if len(texts) * len(ids) ** 4 >= len(holds[c]) * len(n_term[t]) ** 4:
                strong.add(t)
    out = []
    for base, words, free in docs:
        hits = [(s, e, len(w) <= 4 or w[:4] + "*" in strong) for (s, e, w), f in zip(words, free, strict=True) if f and w in strong]
        out.append(([(k, s, e) for k, s, e, _ in base], hits))
    return out, strong


def made(seed):
    rng = random.Random(seed)
    common = ["the", "house", "Étage", "über", "walk", "running", "runners", "x1y", "of", "an"]
    people = [("Johanna", "jo@mail.example.com"), ("Quincy", "+1 (499) 555-6503"), ("Bo", "10.1.2.3"), ("zephyrine", "4111 1111 1111 1111")]
    texts = []
    for k in range(300):
        words = [rng.choice(common) for _ in range(rng.randrange(0, 40))]
        if k % 10 == 0:
            name, value = people[k // 10 % 4]
            at = rng.randrange(len(words) + 1)
            words[at:at] = [name, "wrote from", value]
        if k % 25 == 3:
            words.insert(0, rng.choice(["johanna", "Quincy's", "zephyr"]))
        texts.append(" ".join(words))
    return texts + ["", "", texts[0], texts[0], "contact info@example.org today"] * 3


@pytest.mark.parametrize(("seed", "window"), [(1, 10), (2, 4)])
def test_equals_counting_everything(spark, seed, window):
    texts = made(seed)
    rows = [(k % 290, t or None, "mine", 4) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, term string, near int")
    want, strong = counted_all(texts, window, 3, 0.05)
    assert {"johanna", "quincy", "zephyrine", "joha*"} & strong
    got = disclosure.find(df, window, 3, 0.05).collect()
    plainly = lambda base, terms: ([tuple(s) for s in base], [tuple(t) for t in terms])
    assert sorted((r["doc_id"], plainly(r["base"], r["terms"])) for r in got) == sorted((i, w) for (i, _, _, _), w in zip(rows, want, strict=True))
    # The texts themselves: all columns stay, nothing found is left in them.
    clean = disclosure.sanitised(df, disclosure.find(df, window, 3, 0.05))
    assert clean.columns == df.columns
    after = clean.collect()
    assert sorted((r["doc_id"], r["term"], r["near"]) for r in after) == sorted((r[0], r[2], r[3]) for r in rows)
    assert not any(plain(r["text"] or "") for r in after) and sum(r["text"] is None for r in after) == sum(r[1] is None for r in rows)
    assert any("<email>" in (r["text"] or "") for r in after) and not any("zephyrine" in (r["text"] or "") for r in after)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert disclosure.find(df).count() == 0 and disclosure.sanitised(df).count() == 0
