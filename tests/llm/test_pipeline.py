"""The pipeline's stages against plain versions, on a small fixture."""

import zlib
from collections import Counter

import brute
import pytest
import corpus_pipeline
from gaugeline.llm import jaccard_join, mixing
from gaugeline.llm.common import stored
from gaugeline.llm.queries import tokenizer_path
from pyspark.sql import functions as F
from test_first import docs, reference_ids


def test_stages_follow_each_other(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "jaccard_join", "substring_dedup", "mixing", "packing"]
    source = spark.read.parquet(f"{sf}/documents.parquet")
    tables, now = [], source
    for name, stage in corpus_pipeline.STAGES:
        now = stored(stage(spark, now, sf), name)
        tables.append(now)
    good, single, cut, mixed, packed = tables
    assert all(t.columns == source.columns for t in tables[:-1])
    before = {r["doc_id"]: r for r in source.collect()}
    # Quality: rows stay as they are, clean documents stay.
    kept = {r["doc_id"]: r for r in good.collect()}
    assert all(before[i] == r for i, r in kept.items())
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = [i for i in before if labels.get(i) == 1]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean) and any(i not in kept for i in before)
    # Near copies: the smallest id of each group.
    ids = sorted(kept)
    sets = [brute.shingles(kept[i]["text"]) for i in ids]
    root = brute.linked(sets, lambda a, b: bool(a) and 100 * len(a & b) >= 75 * len(a | b))
    assert sorted(r["doc_id"] for r in single.collect()) == [i for k, i in enumerate(ids) if root[k] == k]
    # Repeated passages: the words kept, in order.
    rows = sorted((r["doc_id"], r["text"]) for r in single.collect())
    want = brute.removed(rows)
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert {i: (len(brute.words(t)), brute.sha(b" ".join(brute.words(t)))) for i, t in texts.items()} == {i: (w[0] - w[1], w[2]) for (i, _), w in zip(rows, want.values(), strict=True)}
    # The mix: rows repeated as often as planned, sources near their targets.
    copies = Counter(r["doc_id"] for r in mixed.collect())
    size, taken, longest = Counter(), Counter(), 0
    for r in cut.collect():
        n = len(brute.words(r["text"]))
        size[r["source"]] += n
        taken[r["source"]] += n * copies[r["doc_id"]]
        longest = max(longest, n)
    target = mixing.targets(size, mixing.cycled(list(size)))
    assert all(abs(taken[s] - target[s]) <= longest for s in size) and max(copies.values()) <= 3
    # Packing: every row's tokens, in sequences that hold them.
    rows = [(r["doc_id"], r["text"] or "") for r in mixed.collect()]
    whole = sum(len(i) + 1 for i in reference_ids([t for _, t in rows]))
    got = packed.collect()
    fill = Counter()
    for r in got:
        fill[r["sequence_id"]] += r["length"]
    assert sum(fill.values()) == whole and max(fill.values()) <= 2048
    first = {i: ids for (i, _), ids in zip(rows, reference_ids([t for _, t in rows]), strict=True)}
    import numpy as np

    for r in got:
        ids = np.asarray([*first[r["doc_id"]], 0], "<u4")[r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"] and ids.tolist() == r["ids"]
    assert tokenizer_path().endswith(".json")


def test_run_writes_every_stage(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"] and got.count() > 100


def test_one_of_equal_rows_stays(spark):
    df = docs(spark, ["a b c d e f", "A b c d e f", "a b c d e f", "z", None, None, ""], [4, 2, 4, 7, 7, None, 9])
    got = sorted((str(r["doc_id"]), r["text"]) for r in jaccard_join.one_of_each(df.unionByName(df)).where("doc_id IS NOT NULL").fillna({"text": "-"}).collect())
    assert got == [("2", "A b c d e f"), ("7", "-"), ("7", "z"), ("9", "")]


CLASHING = ("full", "rest", "cut", "target", "source_size", "_p", "_h", "_s", "_sources", "_copies", "_copy", "_row", "_n", "_text", "row", "place", "several", "node", "gone")


def test_other_columns_may_have_any_name(spark):
    texts = ["a b c d e f", "A b c d e f", "z y x", "k l m n o p q", None]
    df = docs(spark, texts, [4, 2, 4, 7, 9]).withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in CLASHING})
    for got in (jaccard_join.one_of_each(df), mixing.mixed(df)):
        assert got.columns == df.columns
        rows = got.collect()
        assert rows and all(r[c] == f"{c}-{r['doc_id']}" for r in rows for c in CLASHING)
    # Of doc_id 4 only the text goes that is a copy of a smaller document's.
    kept = {(r["doc_id"], r["text"]) for r in jaccard_join.one_of_each(df).collect()}
    assert kept == {(2, "A b c d e f"), (4, "z y x"), (7, "k l m n o p q"), (9, None)}


def test_a_cluster_needs_a_shared_folder(spark):
    """Without spark.checkpoint.dir only a local session gets a folder of its own."""
    from gaugeline.llm import common

    class Session:
        class sparkContext:
            master = "spark://host:7077"

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session)
    Session.sparkContext.master = "local[2]"
    assert common.shared_dir(Session)
