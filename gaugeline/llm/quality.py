"""Quality classifier by co-training: one model of a text's content, one of its page's metadata.

Both start from the labelled sample. In each round both models score all unlabelled documents, and
either model labels those it is surest of for the other one to learn from. At the end each view is
calibrated on labelled rows that it didn't learn from, and the combined views score every document.

The layout's lines count as metadata: beside lang, source and n_chars they tell how a page was
made, not what its text says, and the tables carry no other page metadata.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import documents, stored, text_slices
from gaugeline.llm.labelled import Logistic, held_out, learnt, logit

#: Labelled rows that are learnt from, at most.
SAMPLE = 16_000
ROUNDS = 4
#: Pseudo-labels that a view gives in a round: a share of the unlabelled documents, but at most so many; and how sure it must be.
GIVEN, MOST_GIVEN, SURE = 0.05, 800, 0.9
#: Cells that hold the names of languages and sources.
CELLS = 32
#: Documents with a lower score are rejected.
KEEP = 0.5

_CLASS = np.zeros(256, np.int64)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\v\f", b"\n", b"|", b"#$%&*+=<>@^_~\\/{}[]`", b"!?", b".,;:", b"'\"()-"), 1):
    _CLASS[list(_chars)] = _k
CLASSES = 11


def content(text: bytes) -> list[float]:
    """Shares of character classes, and of words that repeat, are odd or shout."""
    n = len(text)
    words = text.split()
    w = len(words)
    classes = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=CLASSES) / max(1, n)
    counts = Counter(words)
    most = counts.most_common(1)[0][1] / w if w else 0.0
    expected = min(1.0, 6 / np.sqrt(w)) if w else 1.0
    repeats = 1 - len(counts) / w if w else 0.0
    same = sum(a == b for a, b in zip(words, words[1:], strict=False)) / w if w else 0.0
    lone = counts.get(b"|", 0) / w if w else 0.0
    shares = [*classes, most, repeats, same, lone, float(expected)]
    # A trace of a class and much of it are different things: both scales.
    return [*shares, *np.sqrt(classes).tolist(), float(np.log1p(w)), float(np.log1p(n / max(1, w))), float(w == 0)]


def metadata(lang: str | None, source: str | None, n_chars: int | None, lines: int, longest: int) -> list[float]:
    """Language and source by name, the stated length, and the layout's lines."""
    cells = [0.0] * (2 * CELLS)
    for k, name in enumerate((lang, source)):
        cells[k * CELLS + (zlib.crc32(name.encode()) % CELLS if name is not None else CELLS - 1)] = 1.0
    size = float(max(0, n_chars or 0))
    return [*cells, float(np.log1p(size)), float(np.log1p(size) ** 2), float(np.log1p(lines)), float(np.log1p(size / max(1, lines))), float(np.log1p(longest)), float(n_chars is None)]


def _views(batch: pa.RecordBatch, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lang, source, n_chars = (batch.column(c).to_pylist() for c in ("lang", "source", "n_chars"))
    shapes = []
    for t in texts:
        lines = t.split(b"\n")
        shapes.append((len(lines), max(map(len, lines))))
    a = np.asarray([content(t) for t in texts], float)
    b = np.asarray([metadata(*x, *s) for *x, s in zip(lang, source, n_chars, shapes, strict=True)], float)
    return a, b


@dataclass
class CoTrained:
    views: tuple[Logistic, Logistic]
    calibrated: tuple[Logistic, Logistic]
    combined: Logistic

    def each(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Calibrated scores of both views, in columns."""
        return np.column_stack([c.predict(logit(v.predict(x))[:, None]) for v, c, x in zip(self.views, self.calibrated, (a, b), strict=True)])

    def predict(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.combined.predict(logit(self.each(a, b)))


#: A pseudo-label: document, label, and the features of both views.
Given = tuple[int, float, np.ndarray, np.ndarray]
#: For both models and the documents that each has labelled, what each labels next.
Surest = Callable[[tuple[Logistic, Logistic], tuple[set[int], set[int]]], tuple[list[Given], list[Given]]]


def quotas(n: int, rate: float) -> dict[float, int]:
    """Pseudo-labels of each class that a view gives in a round: as many of each as there are of it among the labels."""
    quota = min(MOST_GIVEN, max(1, int(GIVEN * n)))
    return {1.0: round(quota * rate), 0.0: round(quota * (1 - rate))}


def co_train(a: np.ndarray, b: np.ndarray, y: np.ndarray, surest: Surest, aside: np.ndarray, rounds: int = ROUNDS) -> CoTrained:
    """a, b, y: both views and labels; aside: rows kept for calibration. y is 1 for good documents."""
    learn = ~aside if (~aside).any() else np.ones(len(y), bool)
    views = (a, b)
    taught: list[list[Given]] = [[], []]  # what each view has learnt from the other one

    def train(k: int) -> Logistic:
        x = np.concatenate([views[k][learn], *[g[2 + k][None] for g in taught[k]]])
        return Logistic.fit(x, np.r_[y[learn], np.asarray([g[1] for g in taught[k]], float)])

    models = (train(0), train(1))
    for _ in range(rounds):
        new = surest(models, ({g[0] for g in taught[1]}, {g[0] for g in taught[0]}))
        for k in (0, 1):
            taught[1 - k] += new[k]
        models = (train(0), train(1))
    check = aside if aside.any() else learn
    calibrated = tuple(Logistic.fit(logit(m.predict(x[check]))[:, None], y[check]) for m, x in zip(models, views, strict=True))
    both = np.column_stack([c.predict(logit(m.predict(x[check]))[:, None]) for m, c, x in zip(models, calibrated, views, strict=True)])
    return CoTrained(models, calibrated, Logistic.fit(logit(both), y[check]))


_FEATURES = "doc_id long, y int, a array<float>, b array<float>"


def _featured(rows: DataFrame) -> DataFrame:
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            a, b = _views(batch, texts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), *(_lists(x) for x in (a, b))], names=["doc_id", "y", "a", "b"])

    return rows.mapInArrow(features, _FEATURES)


def _lists(x: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(x, np.float32).ravel())
    return pa.FixedSizeListArray.from_arrays(flat, x.shape[1]).cast(pa.list_(pa.float32()))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(pc.list_flatten(column), float).reshape(len(column), -1)


def _from_all(free: DataFrame, rate: float) -> Surest:
    """Both models score all rows of free (doc_id, a, b); of each view and class the surest come to the driver, at most MOST_GIVEN a view."""
    wanted = quotas(free.count(), rate)

    def surest(models: tuple[Logistic, Logistic], gave: tuple[set[int], set[int]]) -> tuple[list[Given], list[Given]]:
        given = [np.asarray(sorted(g), np.int64) for g in gave]

        def confident(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id").to_numpy()
                if not len(ids):
                    continue
                for k, name in enumerate(("a", "b")):
                    p = models[k].predict(_matrix(batch.column(name)))
                    fresh = ~np.isin(ids, given[k])
                    for label, many in wanted.items():
                        sure = p if label else 1 - p
                        hit = np.flatnonzero(fresh & (sure >= SURE))
                        hit = hit[np.lexsort((ids[hit], -sure[hit]))][:many]
                        part = batch.take(pa.array(hit))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), k, np.int32)), pa.array(np.full(len(hit), label)), pa.array(sure[hit]), *(part.column(c) for c in ("doc_id", "a", "b"))], names=["view", "label", "sure", "doc_id", "a", "b"])

        found = free.mapInArrow(confident, "view int, label double, sure double, doc_id long, a array<float>, b array<float>")
        by = Window.partitionBy("view", "label").orderBy(F.col("sure").desc(), "doc_id")
        some = F.when(F.col("label") == 1, wanted[1.0]).otherwise(wanted[0.0])
        best = found.withColumn("place", F.row_number().over(by)).where((F.col("place") <= max(wanted.values())) & (F.col("place") <= some))
        rows = best.orderBy("view", F.col("label").desc(), "place").collect()
        pick = lambda k: [(r["doc_id"], r["label"], np.asarray(r["a"], float), np.asarray(r["b"], float)) for r in rows if r["view"] == k]
        return pick(0), pick(1)

    return surest


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> CoTrained:
    """Trained on about sample labelled documents, and on all others as they are labelled on the way.

    Only features of the sample and of the pseudo-labels reach the driver. An unlabelled doc_id counts once, whatever its rows.
    """
    rows = documents(docs, "doc_id", "text", "lang", "source", "n_chars").where("doc_id IS NOT NULL")
    chosen = learnt(labels, "quality", sample)
    known = _featured(rows.join(F.broadcast(chosen), "doc_id")).toArrow()  # the sample is bounded, so its ids are broadcast
    known = known.take(pc.sort_indices(known, [("doc_id", "ascending")])).combine_chunks()
    labelled = labels.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    # Features of all rows, labelled ones too: they are shuffled, texts never.
    unlabelled = _featured(rows.withColumn("y", F.lit(-1))).join(labelled, "doc_id", "left_anti")
    once = unlabelled.groupBy("doc_id").agg(F.min(F.struct("a", "b")).alias("x"))
    free = stored(once.select("doc_id", "x.a", "x.b"), "features")
    y = (known["y"].to_numpy() > 0).astype(float)
    if len(y):
        a, b = (_matrix(known[c].combine_chunks()) for c in ("a", "b"))
    else:
        a, b = np.zeros((0, len(content(b"")))), np.zeros((0, len(metadata(None, None, 0, 1, 0))))
    aside = np.asarray([zlib.crc32(str(i).encode()) % 5 == 1 for i in known["doc_id"].to_pylist()], bool)
    return co_train(a, b, y, _from_all(free, float(y[~aside].mean()) if (~aside).any() else 0.5), aside)


def scored(docs: DataFrame, model: CoTrained, keep: float = KEEP, whole: bool = False) -> DataFrame:
    """doc_id, held_out, content_score, metadata_score, score and keep of every document; whole: its own columns instead, only of those kept.

    Scores (0 to 1, higher is better) are calibrated; keep says that score is at least keep. Whole
    texts are read. A null text is empty; null lang, source and n_chars have cells of their own. Rows with
    the same or no doc_id are scored each. An empty table gives no rows; without labels all
    documents get 0.5 and stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    row = F.struct(*[F.col(c) for c in docs.columns]) if whole else F.lit(0)
    rows = documents(docs.withColumn("_row", row), "doc_id", "text", "lang", "source", "n_chars", "_row")
    rows = rows.withColumns({"n_chars": F.col("n_chars").cast("long"), "held_out": F.coalesce(held_out(F.col("doc_id")), F.lit(False))})
    kind = rows.schema["_row"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch, texts in text_slices(batches):
            a, b = _views(batch, texts)
            each, both = model.each(a, b), model.predict(a, b)
            out = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(each[:, 0]), pa.array(each[:, 1]), pa.array(both), pa.array(both >= keep), batch.column("_row")], names=["doc_id", "held_out", "content_score", "metadata_score", "score", "keep", "_row"])
            yield out.filter(out.column("keep")) if whole else out

    out = rows.mapInArrow(score, f"doc_id long, held_out boolean, content_score double, metadata_score double, score double, keep boolean, _row {kind}")
    return out.select("_row.*") if whole else out.drop("_row")
