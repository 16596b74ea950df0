"""The whole query against a plain version of it, and what the index holds."""

from collections import Counter

import numpy as np
import pytest

from gaugeline.llm import toxicity
from gaugeline.llm.common import word_hashes
from gaugeline.llm.labelled import Logistic, held_out


def test_all_examples_are_indexed(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = docs.select("doc_id", "text").join(labels.where("toxic IS NOT NULL"), "doc_id").where(~held_out(docs["doc_id"])).select(docs["doc_id"], "text", "toxic").collect()
    terms = {r["doc_id"]: set(toxicity.terms_of(r["text"] or "")) for r in rows}
    assert sorted(model.index.ids.tolist()) == sorted(i for i, t in terms.items() if t)
    assert sorted(model.index.terms.tolist()) == sorted(word_hashes([t.encode() for t in set().union(*terms.values())]).tolist())
    assert len(model.index.rows) == sum(map(len, terms.values()))
    held = docs.where(held_out(docs["doc_id"])).where("text RLIKE '[a-z]{4}'")
    got = toxicity.score_documents(held, model).collect()
    assert sum(bool(r["evidence"]) for r in got) >= 0.99 * len(got) > 0


def plain(docs, labels, k=toxicity.NEIGHBOURS):
    """Scores of all texts: every cosine taken, nothing indexed."""
    import zlib

    counts = {i: Counter(toxicity.terms_of(t or "")) for i, t in docs}
    df = Counter(t for c in counts.values() for t in c)
    idf = {t: np.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items()}
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in docs}
    known = [(i, labels[i], counts[i]) for i in sorted(counts) if i in labels and fold[i]]
    space = {t for _, _, c in known for t in c}

    def unit(c):
        w = {t: (1 + np.log(n)) * idf[t] for t, n in c.items() if t in space}
        norm = np.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()}

    units = [(i, y, unit(c)) for i, y, c in known if c]

    def near(c, without=None):
        u = unit(c)
        found = [(-sum(x * v.get(t, 0) for t, x in u.items()), i, y) for i, y, v in units if i != without]
        return [(-s, i, y) for s, i, y in sorted((round(s, 12), i, y) for s, i, y in found) if s < 0][:k]

    def vote(found):
        w = np.asarray([1 / (1.05 - s) for s, _, _ in found])
        return float((w * [y for *_, y in found]).sum() / w.sum()), found[0][0]

    votes = sorted((*vote(n), y) for i, y, c in known if c and (n := near(c, i)))
    y = np.asarray([v[2] for v in votes], float)
    fitted = Logistic.fit(np.asarray([v[:2] for v in votes]), np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)))
    bare = [y for _, y, c in known if not c]
    rest = (1 + sum(bare)) / (20 + len(bare))
    return {i: (float(fitted.predict(np.asarray([vote(n)]))[0]), [e[1] for e in n[:3]]) if (n := near(counts[i])) else (rest, []) for i, _ in docs}


def test_scores_equal_a_plain_version(spark):
    rng = np.random.default_rng(6)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}{'x' * (k % 5)}" for k in range(120)]
    docs, labels = [], {}
    for i in range(260):
        y = int(rng.random() < 0.3)
        said = [words[int(rng.random() ** 2 * 110)] for _ in range(rng.integers(0, 40))] + ([words[110 + int(j)] for j in rng.integers(0, 10, 3)] if y else [])
        docs.append((i, " ".join(said)))
        if rng.random() < 0.8:
            labels[i] = y
    docs += [(900, None), (901, ""), (902, "Zz 12 !"), (903, docs[3][1]), (904, "nothing known")]
    labels |= {900: 0, 903: 1}
    # Columns named like the operator's own are left alone.
    df = spark.createDataFrame([(*d, 5, 6) for d in docs], "doc_id long, text string, y int, score int")
    given = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_documents(df, toxicity.fit(df, given)).collect()}
    want = plain(docs, labels)
    assert got.keys() == want.keys()
    for i, (score, near) in want.items():
        assert got[i]["score"] == pytest.approx(score, abs=1e-6)
        assert [e["doc_id"] for e in got[i]["evidence"]] == near


def test_more_examples_are_not_worse(spark):
    """Held-out accuracy at two bounds of the sample."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = labels.where("toxic IS NOT NULL").where(held_out(labels["doc_id"]))
    mine = docs.join(held.select("doc_id"), "doc_id", "left_semi")
    y = {r["doc_id"]: r["toxic"] for r in held.collect()}
    found = []
    for sample in (600, toxicity.SAMPLE):
        got = toxicity.score_documents(mine, toxicity.fit(docs, labels, sample=sample)).collect()
        score = np.asarray([r["score"] for r in got])
        label = np.asarray([y[r["doc_id"]] for r in got])
        order = np.argsort(np.argsort(score)) + 1
        found.append((order[label == 1].sum() - label.sum() * (label.sum() + 1) / 2) / (label.sum() * (1 - label).sum()))
    assert found[1] >= max(0.9, found[0])
