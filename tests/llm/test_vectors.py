"""Embedding near-dedup and fingerprints against plain versions."""

import math

import numpy as np
import pytest

import brute
from gaugeline.llm import embedding_dedup, fingerprints
from gaugeline.llm.queries import QUERIES
from test_first import WEIRD, docs, rows

VECTORS = "vec_id long, embedding array<float>, label int, n_links int"


def plain_links(data, cosine=0.93):
    """data: (vec_id, embedding, label): rows of vec_id, n_links, component_id, kept."""
    units = []
    for _, e, label in data:
        x = np.asarray([np.nan if v is None else v for v in e], float) if e else np.zeros(0)
        ok = label is not None and x.size and np.isfinite(x).all() and x.any()
        units.append(x / np.sqrt((x * x).sum()) if ok else None)
    near = lambda a, b: units[a] is not None and units[b] is not None and data[a][2] == data[b][2] and len(units[a]) == len(units[b]) and float(units[a] @ units[b]) >= cosine
    n = len(data)
    links = [sum(near(a, b) for b in range(n) if b != a) for a in range(n)]
    root = brute.linked(range(n), near)
    least = {}
    for k, (i, *_) in enumerate(data):
        if i is not None:
            least[root[k]] = min(least.get(root[k], i), i)
    return sorted(((i, links[k], least.get(root[k]), i is not None and least.get(root[k]) == i) for k, (i, *_) in enumerate(data)), key=repr)


def vectors(seed=1, dims=16):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(25):
        centre = rng.standard_normal(dims)
        for _ in range(rng.integers(1, 9)):
            out.append((centre / np.linalg.norm(centre) + rng.standard_normal(dims) * rng.choice([0.001, 0.02, 0.04])).astype(np.float32).tolist())
    return out


def test_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 7)
    made = vectors() + vectors(2)[:10]
    data = [(k, v, int(k % 3 > 0)) for k, v in enumerate(made + made[:20])]
    data += [(900, None, 1), (901, [0.0] * 16, 1), (902, [math.nan] + [1.0] * 15, 1), (903, [None] + [1.0] * 15, 1), (904, [math.inf] * 16, 1), (905, made[0], None), (906, [], 1), (907, [1.0, 2.0], 1), (908, [2.0, 4.0], 1), (5, made[1], 1), (None, made[1], 1), (None, made[3] * 2, 0), (7, made[7], 1)]
    df = spark.createDataFrame([(*d, 0) for d in data], VECTORS).repartition(3)
    # Wide windows: every pair at the threshold is found but for one in a million.
    plan = embedding_dedup.calibrated(width=5.5)
    got = rows(embedding_dedup.near_duplicates(df, plan=plan), "vec_id", "n_links", "component_id", "kept")
    assert got == plain_links(data) and sum(r[1] for r in got) > 100
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


def test_recall_of_borderline_pairs(spark):
    rng = np.random.default_rng(4)
    data = []
    for k in range(400):
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = 0.9302
        data += [(2 * k, a.astype(np.float32).tolist(), 1), (2 * k + 1, (c * a + math.sqrt(1 - c * c) * b).astype(np.float32).tolist(), 1)]
    want = sum(r[1] for r in plain_links(data))
    got = embedding_dedup.near_duplicates(spark.createDataFrame([(*d, 0) for d in data], VECTORS)).collect()
    assert 0.95 * want <= sum(r["n_links"] for r in got) <= want


def test_calibrated_count():
    plan = embedding_dedup.calibrated()
    hit = math.erf(embedding_dedup.WIDTH / math.sqrt(2))
    chance = lambda c: sum(math.comb(24, k) * hit**k * (1 - hit) ** (24 - k) for k in range(c, 25))
    assert chance(plan.count) >= 0.99 > chance(plan.count + 1)


def test_embeddings_query(spark, sf):
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert rows(QUERIES["op5_embedding_dedup"](spark, sf), "vec_id", "n_links", "component_id", "kept") == plain_links(data)


# --- fingerprints


def plain_prints(data, band=fingerprints.BAND):
    """data: (doc_id, text) with distinct ids: rows of the query."""
    import hashlib
    import re
    from collections import Counter

    data = sorted((i, t or "") for i, t in data)
    terms = lambda t: {w for w in re.split(r"[\x20\x09-\x0D]+", t.lower()) if w}
    df = Counter(w for _, t in data for w in terms(t))
    lexicon = {w for w, n in df.items() if band[0] * len(data) <= n <= band[1] * len(data)}
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    subset = {w: [int(md5(f"{k}:{w}")[:2], 16) < c for k, c in enumerate(fingerprints.SUBSETS)] for w in lexicon}

    def prints(t):
        held = sorted(terms(t) & lexicon, key=lambda w: w.encode())
        parts = [[w for w in held if subset[w][k]] for k in range(len(fingerprints.SUBSETS))]
        return [md5(" ".join(p))[: fingerprints.DIGITS] if p else None for p in parts]

    def alike(a, b, same):
        if same:
            return 1.0
        pairs = [(x, y) for x, y in zip(a, b, strict=True) if x or y]
        return sum(x == y for x, y in pairs) / len(pairs) if any(a) and any(b) else 0.0

    out = []
    for k, (i, t) in enumerate(data):
        other = data[(k + 1) % len(data)][1]
        h = len(t) // 2
        edited = t[: len(t) - h] + other[:h]
        p, e, o = prints(t), prints(edited), prints(other)
        show = lambda p: "".join(x or "-" * fingerprints.DIGITS for x in p) if any(p) else "="
        out.append((i, len(t), brute.sha(edited), show(p), show(e), alike(p, e, p == e and (any(p) or t == edited)), alike(p, o, p == o and (any(p) or t == other))))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def shown(df):
    return sorted(((*r[:3], *("=" if x.startswith("=") else x for x in r[3:5]), *r[5:]) for r in rows(df, *COLUMNS)), key=repr)


def test_fingerprint_query(spark, sf):
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = shown(QUERIES["op6_fingerprints"](spark, sf))
    assert got == plain_prints(data)
    assert sum(r[5] for r in got) > 20 * sum(r[6] for r in got if r[6] < 1)


def test_fingerprint_edges(spark):
    texts = [t for t in WEIRD if t != " x "] + ["common one", "common two", "common one", "", "😀😀 a", "x"]
    ids = [3 * k - 7 if k % 2 else 5000 * k for k in range(len(texts))]
    data = list(zip(ids, texts, strict=True))
    assert shown(fingerprints.compare_edited(docs(spark, texts, ids), (0.1, 0.9))) == plain_prints(data, (0.1, 0.9))


def test_fingerprints_of_repeated_ids(spark):
    df = docs(spark, ["a b", "a b", "c d e", "f", None, "n n"], [1, 1, 1, 2, None, None])
    got = rows(fingerprints.compare_edited(df, (0.1, 0.9)), "doc_id", "n_chars", "edited_sha256")
    sha = brute.sha
    assert got == sorted([(1, 3, sha("a f")), (1, 3, sha("a f")), (1, 5, sha("c df")), (2, 1, sha("f")), (None, 0, sha("")), (None, 3, sha("n "))], key=repr)
    assert fingerprints.compare_edited(df.where("false")).count() == 0


@pytest.mark.parametrize("ids", [[1], [5, 1, 3], list(range(0, 5000, 7)), [-(10**12), -1, 0, 3 * 10**6, 10**15]])
def test_successors(spark, ids):
    got = {r["doc_id"]: r["next_id"] for r in fingerprints.successors(spark.createDataFrame([(i,) for i in ids], "doc_id long")).collect()}
    s = sorted(ids)
    assert got == dict(zip(s, s[1:] + s[:1], strict=True))
