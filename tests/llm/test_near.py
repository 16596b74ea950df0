"""Jaccard join against all pairs."""

import os
import random

import brute
from gaugeline.llm import common, jaccard_join
from gaugeline.llm.queries import QUERIES
from test_first import WEIRD, docs, rows


def want_components(data):
    """data: (doc_id, text): rows of doc_id, n_shingles, component_id."""
    sets = [frozenset(brute.shingles(t)) for _, t in data]
    distinct = sorted(set(sets), key=lambda s: sorted(s))
    near = lambda a, b: bool(a) and 100 * len(a & b) >= 75 * len(a | b)
    group = dict(zip(distinct, brute.linked(distinct, near), strict=True))
    least = {}
    for (i, _), s in zip(data, sets, strict=True):
        if s and i is not None:
            least[group[s]] = min(least.get(group[s], i), i)
    return sorted(((i, len(s), least.get(group[s]) if s else i) for (i, _), s in zip(data, sets, strict=True)), key=repr)


def changed(rng, words, share):
    return [f"n{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def near_texts(seed, groups=14, vocabulary=300):
    rng = random.Random(seed)
    texts = []
    passage = [f"p{i}" for i in range(40)]
    for _ in range(groups):
        words = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.choice([3, 5, 6, 7, 8, 9, 12, 16, 25, 60, 300]))]
        if rng.random() < 0.4:
            words += passage
        for _ in range(rng.randrange(1, 12)):
            more = changed(rng, words, rng.choice([0, 0.01, 0.03, 0.05]))
            cut = rng.randrange(max(1, len(more) // 5))
            texts.append(" ".join(more[cut:]) if rng.random() < 0.5 else " ".join(more).upper())
    rng.shuffle(texts)
    return texts


def test_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "STAR", 2)
    for seed in (1, 2):
        texts = near_texts(seed) + WEIRD[:8] + ["x " * 300, "a b c", "A B\tc", "a b c d"]
        data = list(enumerate(texts)) + [(3, "dup " * 30), (None, texts[0]), (None, "alone in the world of nulls"), (-5, texts[9])]
        got = jaccard_join.join_near(docs(spark, [t for _, t in data], [i for i, _ in data]).repartition(3))
        assert rows(got, "doc_id", "n_shingles", "component_id") == want_components(data)


def test_small_boundary_does_not_matter(spark, monkeypatch):
    texts = near_texts(5)
    want = want_components(list(enumerate(texts)))
    for b in (0, 10, 64):
        monkeypatch.setattr(jaccard_join, "boundary", lambda *a, b=b: b)
        assert rows(jaccard_join.join_near(docs(spark, texts)), "doc_id", "n_shingles", "component_id") == want


def test_chain_of_near_copies(spark):
    """A long chain, of which neighbours link: one component; the smallest id at its end."""
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[8 * k : 8 * k + 100]) for k in range(12)]
    got = jaccard_join.join_near(docs(spark, texts, [12 - k for k in range(12)]))
    assert {r["component_id"] for r in got.collect()} == {1}


def test_empty_table(spark):
    assert jaccard_join.join_near(docs(spark, ["x"]).where("false")).count() == 0


def test_boundary_follows_cost():
    assert jaccard_join.boundary({300: 10}, 1.0) == 0
    assert jaccard_join.boundary({6: 1000, 300: 10}, 50.0) >= 6


def test_jaccard_query(spark, sf):
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES["op4_jaccard_join"](spark, sf), "doc_id", "n_shingles", "component_id") == want_components(data)


def test_components_of_paths(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 3)] + [(300, 300 + k) for k in range(1, 40)]
    links = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in links]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 200: 100, 150: 100, **dict.fromkeys(range(300, 340), 300)}


def test_stored_sets_are_smaller_than_their_texts(spark):
    """The sets that verification reads are stored as texts: 64-bit hashes of each shingle took more than the texts."""
    rng = random.Random(7)
    texts = []
    for _ in range(20):
        words = [f"w{rng.randrange(50)}" for _ in range(2000)]
        texts += [" ".join(words), " ".join(changed(rng, words, 0.002))]
    folder = f"{common.shared_dir(spark)}/llm"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    got = jaccard_join.join_near(docs(spark, texts))
    assert rows(got, "doc_id", "n_shingles", "component_id") == want_components(list(enumerate(texts)))
    stored = [f"{folder}/{d}" for d in set(os.listdir(folder)) - before if d.startswith("sets-")]
    size = lambda d: sum(os.path.getsize(f"{r}/{f}") for r, _, fs in os.walk(d) for f in fs if f.endswith(".parquet"))
    assert stored and max(size(d) for d in stored) < sum(len(t) for t in texts)
