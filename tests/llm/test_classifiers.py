"""Toxicity and quality: exact neighbours, held-out accuracy, odd rows."""

import random

import numpy as np
import pytest

from gaugeline.llm import quality, toxicity
from gaugeline.llm.labelled import Logistic
from gaugeline.llm.queries import QUERIES
from test_first import WEIRD


def test_block_max_search_is_exact():
    """Blocks that differ, so that bounds leave some of them out; ties go to smaller ids."""
    rng = random.Random(1)
    n_terms = 100
    idf = np.asarray([1 + rng.random() + 2 * (t >= 40) for t in range(n_terms)])
    # Twenty kinds of examples with three terms of their own each, and terms that all may have.
    made = lambda kind: {t: rng.choice([1, 1, 2, 5]) for t in {0, 1, *(rng.randrange(2, 40) for _ in range(rng.randrange(1, 6))), *rng.sample(range(40 + 3 * kind, 43 + 3 * kind), 2)}}
    examples = [(5 * i + 3, rng.randrange(2), made(i % 20)) for i in range(700)]
    rows = np.repeat(np.arange(700), [len(c) for *_, c in examples])
    index = toxicity.Index.of(np.arange(n_terms, dtype=np.uint64), idf, np.asarray([i for i, *_ in examples]), np.asarray([y for _, y, _ in examples]), rows, np.asarray([t for *_, c in examples for t in c]), np.asarray([x for *_, c in examples for x in c.values()]))

    def unit(c):
        w = {t: (1 + np.log(x)) * idf[t] for t, x in c.items()}
        norm = np.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()}

    data = {i: unit(c) for i, _, c in examples}
    scored, whole = [], 0
    lengths = np.diff(index.begins)
    real = np.bincount

    def counting(x, *a, **kw):
        if kw.get("minlength") == 700:
            scored.append(len(x))
        return real(x, *a, **kw)

    for k in range(80):
        query, without = (examples[k][2], examples[k][0]) if k % 2 else (made(k % 20), None)
        q = unit(query)
        want = sorted((-round(sum(w * d.get(t, 0) for t, w in q.items()), 9), i) for i, d in data.items() if i != without)[: toxicity.NEIGHBOURS]
        places = np.asarray(sorted(query))
        whole += sum(lengths[t] for t in query if index.place[t] < 0)
        toxicity.np.bincount = counting
        try:
            ((rows_, cosines),) = index.nearest(np.zeros(len(places), np.int64), places, np.asarray([query[t] for t in places]), 1, without=[without])
        finally:
            toxicity.np.bincount = real
        assert np.round(cosines, 9).tolist() == pytest.approx([-s for s, _ in want if s < 0], abs=2e-9)
        assert without not in index.ids[rows_].tolist()
        assert all(sum(w * data[int(index.ids[r])].get(t, 0) for t, w in q.items()) == pytest.approx(c) for r, c in zip(rows_, cosines, strict=True))
    assert sorted(index.ids.tolist()) == sorted(i for i, *_ in examples) and len(index.dense) > 2
    # Fewer postings are touched than the queries' terms have.
    assert sum(scored) < 0.9 * whole
    none = np.zeros(0, np.int64)
    assert [r.size for r, _ in index.nearest(none, none, none, 2)] == [0, 0]


def test_terms_of_words():
    assert toxicity.terms_of("Loweien,") == ["loweien", "lowe*", "lowei*"]
    assert toxicity.terms_of("a-42b") == ["a", "b"] and toxicity.terms_of("!") == []
    texts = ["Loweien, a-42b a", "", "über LOWEien über"]
    text, terms, n = toxicity.term_counts([t.encode() for t in texts])
    got = {(t, h): c for t, h, c in zip(text.tolist(), terms.tolist(), n.tolist(), strict=True)}
    from collections import Counter

    from gaugeline.llm.common import word_hashes
    assert got == {(k, int(word_hashes([w.encode()])[0])): c for k, t in enumerate(texts) for w, c in Counter(toxicity.terms_of(t)).items()}
    assert toxicity.term_counts([])[0].size == 0


def auc(score, y):
    order = np.argsort(np.argsort(score)) + 1
    return (order[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())


@pytest.mark.parametrize(("name", "column", "least"), [("op1_toxicity", "toxic", 0.75), ("op2_quality_classifier", "quality", 0.97)])
def test_held_out_accuracy(spark, name, column, least):
    sf = "/root/testdata/sf0.01"
    got = QUERIES[name](spark, sf).toPandas()
    assert len(got) == 1000 and got["doc_id"].is_unique and got["score"].between(0, 1).all()
    import zlib

    assert got["held_out"].tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    held = got[got["held_out"]].merge(labels, on="doc_id")
    assert auc(held["score"].to_numpy(), held[column].to_numpy()) >= least
    good = held[held[column] == (1 if column == "quality" else 0)]
    assert (good["score"] >= 0.5).mean() >= 0.97 if column == "quality" else (good["score"] < 0.5).mean() >= 0.97


def odd(spark):
    return spark.createDataFrame([(i, t, None if i % 2 else "en", None if i % 3 else "s", None if i % 5 else len(t or ""), 0.1) for i, t in enumerate(WEIRD)] + [(None, "trash talk", "en", "s", 9, 0.1), (1, "x", None, None, -4, 0.1)], "doc_id long, text string, lang string, source string, n_chars long, score double")


def test_odd_rows_are_scored(spark):
    df = odd(spark)
    labels = spark.createDataFrame([(i, i % 2, i % 2, "x") for i in range(6)] + [(None, 1, 1, "x"), (3, None, None, "x"), (0, 1, 0, "x")], "doc_id long, quality int, toxic int, text string")
    for label in (labels, labels.where("false")):
        for got in (toxicity.score_documents(df, toxicity.fit(df, label)).collect(), quality.scored(df, quality.fit(df, label)).collect()):
            assert len(got) == df.count() and all(0 <= r["score"] <= 1 for r in got)
    model = quality.fit(df, labels)
    kept = quality.scored(df, model, keep=0.0, whole=True)
    assert kept.columns == df.columns and sorted(kept.collect(), key=repr) == sorted(df.collect(), key=repr)
    assert quality.scored(df.where("false"), model).count() == 0
    assert toxicity.score_documents(df.where("false"), toxicity.fit(df, labels)).count() == 0


def pooled(a, b, rate):
    """What _from_all() does, over arrays."""
    wanted = quality.quotas(len(a), rate)

    def surest(models, gave):
        out = []
        for k, x in enumerate((a, b)):
            p = models[k].predict(x)
            mine = []
            for label, many in wanted.items():
                sure = p if label else 1 - p
                free = [i for i in np.argsort(-sure, kind="stable").tolist() if sure[i] >= quality.SURE and i not in gave[k]]
                mine += [(i, label, a[i], b[i]) for i in free[:many]]
            out.append(mine)
        return out

    return surest


def made_views(n):
    rng = np.random.default_rng(3)
    y = (rng.random(n) < 0.5).astype(float)
    a = (y * 4 - 2)[:, None] + rng.standard_normal((n, 3))
    b = np.column_stack([(y * 2 - 1) * 0.6 + rng.standard_normal(n) for _ in range(3)] + [rng.standard_normal(n) for _ in range(40)])
    return y, a, b


def test_views_teach_each_other():
    """Few labels: the view that knows lifts the one that doesn't, and more over a larger pool."""
    y, a, b = made_views(3000)
    aside = np.arange(24) % 4 == 0
    alone = Logistic.fit(b[:24][~aside], y[:24][~aside])
    lifted = [auc(alone.predict(b[24:]), y[24:])]
    for pool in (100, 2976):
        model = quality.co_train(a[:24], b[:24], y[:24], pooled(a[24 : 24 + pool], b[24 : 24 + pool], y[:24].mean()), aside)
        lifted.append(auc(model.views[1].predict(b[24:]), y[24:]))
    assert lifted[2] > max(lifted[:2]) + 0.02
    assert auc(model.predict(a[24:], b[24:]), y[24:]) > 0.95


def test_all_unlabelled_documents_take_part(spark):
    """The pseudo-labels are the surest of the whole table, wherever they lie, and none is given twice."""
    y, a, b = made_views(900)
    df = spark.createDataFrame([(i, a[i].tolist(), b[i].tolist()) for i in range(900)], "doc_id long, a array<float>, b array<float>").repartition(5)
    a, b = a.astype(np.float32).astype(float), b.astype(np.float32).astype(float)
    models = Logistic.fit(a[:60], y[:60]), Logistic.fit(b[:60], y[:60])
    gave = ({5, 17, 800}, {3})
    got, want = quality._from_all(df, 0.4)(models, gave), pooled(a, b, 0.4)(models, gave)
    for mine, plain in zip(got, want, strict=True):
        assert [(g[0], g[1]) for g in mine] == [(g[0], g[1]) for g in plain] and len(mine) > 20
        assert all(np.array_equal(g[2], a[g[0]]) and np.array_equal(g[3], b[g[0]]) for g in mine)
