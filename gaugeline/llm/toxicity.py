"""Toxicity: votes of the nearest labelled examples by exact TF-IDF cosine, over a block-max inverted index.

The examples are a bounded sample of labelled texts; their terms, whatever the labels, span the
space, and weights count over all documents. Rows of the index are arranged so that examples that
are alike share a block, and a block knows, for each of its terms only, the largest weight. Terms
that many of the examples hold would bound nothing; their weights are a dense table. A query
adds both up to bounds; the most promising blocks are scored from their postings, then those whose
bound reaches the k-th cosine found, so the k nearest examples are exact. Their votes, weighted
by distance, are calibrated with each example's own left-out vote.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import documents, pack, stored, text_slices, unpack, word_hashes
from gaugeline.llm.labelled import Logistic, held_out, learnt
from gaugeline.llm.tokens import words_of

#: Labelled rows that are learnt from, at most.
SAMPLE = 3_000
BEGINNINGS = (4, 5)
NEIGHBOURS = 15
#: Rows of a block, and the share of rows from which on a term's weights are dense.
BLOCK, DENSE = 32, 1 / 16
#: Queries whose dense part is taken at once; texts whose result a task remembers.
TOGETHER, MEMORY = 256, 20_000

_LETTERS = re.compile(r"(?:[A-Za-z]|[^\x00-\x7F])+")
_INSIDE = np.zeros(256, bool)
_INSIDE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_INSIDE[0x80:] = True


def terms_of(text: str) -> list[str]:
    """The terms of a text: its runs of letters (beyond ASCII, of anything), in lower case, and their beginnings (with a star)."""
    out = []
    for run in _LETTERS.findall(text):
        run = run.lower()
        out.append(run)
        out += [run[:n] + "*" for n in BEGINNINGS if len(run) > n]
    return out


def term_counts(texts: list[bytes], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of all texts' terms, by text and term: hashed, or their places in the sorted hashes known, without others."""
    low = [t.lower() if t.isascii() else t.decode("utf-8", "replace").lower().encode() for t in texts]
    words = words_of(low, b"\n".join(low), _INSIDE)
    table = np.zeros((len(words.names), 1 + len(BEGINNINGS)), np.uint64)
    there = np.zeros(table.shape, bool)
    table[:, 0], there[:, 0] = words.hashes, True
    plain = [n if n.isascii() else n.decode("utf-8", "replace") for n in words.names]
    for k, size in enumerate(BEGINNINGS, 1):
        long = [j for j, n in enumerate(plain) if len(n) > size]
        there[long, k] = True
        table[long, k] = word_hashes([n[:size] + b"*" if isinstance(n, bytes) else n[:size].encode() + b"*" for n in map(plain.__getitem__, long)])
    unique, codes = np.unique(table, return_inverse=True)
    codes = codes.reshape(table.shape)
    if known is not None:
        place = np.searchsorted(known, unique)
        ok = known[np.minimum(place, len(known) - 1)] == unique if len(known) else np.zeros(len(unique), bool)
        there &= ok[codes]
    picked = there[words.ids]
    text = np.broadcast_to(words.text[:, None], picked.shape)[picked]
    pairs, n = np.unique(text * np.int64(len(unique) + 1) + codes[words.ids][picked], return_counts=True)
    code = pairs % (len(unique) + 1)
    return pairs // (len(unique) + 1), (unique if known is None else place)[code], n


def _flat(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of several runs, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def arranged(rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, size: int = BLOCK) -> np.ndarray:
    """An order of n rows in which those alike stand together: halved along their main direction again and again."""
    order = np.argsort(rows, kind="stable")
    rows, terms, weights = rows[order], terms[order], weights[order]
    begins = np.searchsorted(rows, np.arange(n + 1))
    width = int(terms.max()) + 1 if len(terms) else 1
    done, todo = [], [np.arange(n)]
    while todo:
        group = todo.pop()
        if len(group) <= size:
            done.append(group)
            continue
        at = _flat(begins[group], begins[group + 1] - begins[group])
        local = np.repeat(np.arange(len(group)), begins[group + 1] - begins[group])
        t, w = terms[at], weights[at]
        side = np.linspace(-1, 1, len(group))
        for _ in range(5):
            side = side - side.mean()
            direction = np.bincount(t, w * side[local], minlength=width)
            side = np.bincount(local, w * direction[t], minlength=len(group))
            side /= np.abs(side).max() or 1
        split = np.argsort(side, kind="stable")
        half = max(size, (len(group) // 2 + size - 1) // size * size)
        todo += [group[split[half:]], group[split[:half]]]
    return np.concatenate(done) if done else np.zeros(0, np.int64)


@dataclass
class Index:
    """Postings of unit vectors by term and row. terms: their sorted hashes; those of term t lie from begins[t] to begins[t + 1]."""

    terms: np.ndarray
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    begins: np.ndarray
    rows: np.ndarray
    weights: np.ndarray

    def __post_init__(self) -> None:
        lengths = np.diff(self.begins)
        term = np.repeat(np.arange(len(self.terms)), lengths)
        many = np.flatnonzero(lengths > DENSE * len(self.ids))
        self.place = np.full(len(self.terms), -1)
        self.place[many] = np.arange(len(many))
        # At most 1 / DENSE tables of the postings' own size.
        self.dense = np.zeros((len(many), len(self.ids)))
        here = self.place[term] >= 0
        self.dense[self.place[term[here]], self.rows[here]] = self.weights[here]
        # Block maxima, only of blocks that hold the term: entry e is of block blocks[e], its postings begin at cuts[e].
        block = self.rows // BLOCK
        fresh = np.flatnonzero(np.r_[True, (np.diff(term) != 0) | (np.diff(block) != 0)]) if len(term) else np.zeros(0, np.int64)
        self.cuts = np.r_[fresh, len(term)]
        self.blocks = block[fresh]
        self.maxima = np.maximum.reduceat(self.weights, fresh) if len(fresh) else np.zeros(0)
        self.firsts = np.searchsorted(term[fresh], np.arange(len(self.terms) + 1))

    def __reduce__(self) -> tuple:
        """Travels compressed, rows as steps and without the block maxima."""
        return _read, tuple(map(pack, (self.terms, self.idf, self.ids, self.labels, self.begins, np.diff(self.rows, prepend=np.int32(0)), self.weights)))

    @classmethod
    def of(cls, terms: np.ndarray, idf: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, places: np.ndarray, counts: np.ndarray) -> Index:
        """From flat arrays: row, place of the term and count of every term of every example."""
        values = (1 + np.log(counts)) * idf[places]
        norms = np.sqrt(np.bincount(rows, values**2, minlength=len(ids)))
        values = values / np.where(norms > 0, norms, 1)[rows]
        order = arranged(rows, places, values, len(ids))
        now = np.empty(len(ids), np.int64)
        now[order] = np.arange(len(ids))
        rows = now[rows]
        held = values > 0
        rows, places, values = rows[held], places[held], values[held]
        sort = np.lexsort((rows, places))
        begins = np.r_[0, np.cumsum(np.bincount(places, minlength=len(terms)))]
        return cls(terms, idf, ids[order], labels[order], begins, rows[sort].astype(np.int32), values[sort])

    def nearest(self, text: np.ndarray, places: np.ndarray, counts: np.ndarray, many: int, k: int = NEIGHBOURS, without: Sequence[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of each of many texts (terms and counts in their order) rows and cosines of the k nearest examples, none at cosine 0; of examples as far away, those of smaller ids.

        without: for each text an id that is left out.
        """
        values = (1 + np.log(counts)) * self.idf[places]
        norms = np.sqrt(np.bincount(text, values**2, minlength=many))
        values = values / np.where(norms > 0, norms, 1)[text]
        edges = np.searchsorted(text, np.arange(many + 1))
        dense = self.place[places]
        for low in range(0, many, TOGETHER):
            high = min(many, low + TOGETHER)
            part = np.arange(edges[low], edges[high])
            part = part[dense[part] >= 0]
            queries = np.zeros((high - low, len(self.dense)))
            queries[text[part] - low, dense[part]] = values[part]
            base = queries @ self.dense
            for j in range(low, high):
                own = np.arange(edges[j], edges[j + 1])
                own = own[dense[own] < 0]
                yield self._nearest(base[j - low], places[own], values[own], k, None if without is None else without[j])

    def _nearest(self, scores: np.ndarray, places: np.ndarray, query: np.ndarray, k: int, without: int | None) -> tuple[np.ndarray, np.ndarray]:
        """From the dense terms' part of every cosine, and the other terms."""
        if not len(scores):
            return np.zeros(0, np.int64), np.zeros(0)
        lengths = self.firsts[places + 1] - self.firsts[places]
        entries = _flat(self.firsts[places], lengths)
        factor = np.repeat(query, lengths)
        block = self.blocks[entries]
        many = (len(self.ids) + BLOCK - 1) // BLOCK
        # A cosine is at most the sum of the maxima; rounding may add a little.
        bound = np.maximum.reduceat(scores, np.arange(0, len(scores), BLOCK)) + np.bincount(block, factor * self.maxima[entries], minlength=many) + 1e-9
        order = np.argsort(-bound, kind="stable")
        seen, done = np.zeros(many, bool), np.zeros(len(scores))
        at, step, least = 0, 2 + 2 * k // BLOCK, 0.0
        while at < many and bound[order[at]] > least:
            chosen = order[at : at + step]
            chosen = chosen[bound[chosen] > least]
            mask = np.zeros(many, bool)
            seen[chosen] = mask[chosen] = True
            here = np.flatnonzero(mask[block])
            e = entries[here]
            n = self.cuts[e + 1] - self.cuts[e]
            postings = _flat(self.cuts[e], n)
            scores = scores + np.bincount(self.rows[postings], np.repeat(factor[here], n) * self.weights[postings], minlength=len(scores))
            # Rows of other blocks have only a part of their cosine yet.
            done = np.where(np.repeat(seen, BLOCK)[: len(scores)], scores, 0.0)
            if without is not None:
                done[self.ids == without] = 0
            least = float(np.partition(done, -k)[-k]) - 1e-9 if len(done) > k else 0.0
            at, step = at + step, many
        # Equal examples get equal cosines, whatever the order of the sums.
        done = np.round(done, 12)
        hit = np.flatnonzero((done >= least) & (done > 0))
        hit = hit[np.lexsort((self.ids[hit], -done[hit]))][:k]
        return hit, done[hit]

    def vote(self, rows: np.ndarray, cosines: np.ndarray) -> tuple[float, float]:
        """The distance-weighted share of label 1 among the neighbours, and the nearest one's cosine."""
        weights = 1 / (1.05 - cosines)
        return float((weights * self.labels[rows]).sum() / weights.sum()), float(cosines[0])


def _read(*packed: bytes) -> Index:
    kinds = (np.uint64, np.float64, np.int64, np.int64, np.int64, np.int32, np.float64)
    terms, idf, ids, labels, begins, steps, weights = (unpack(b, k) for b, k in zip(packed, kinds, strict=True))
    return Index(terms, idf, ids, labels, begins, np.cumsum(steps, dtype=np.int32), weights)


@dataclass
class Model:
    index: Index
    calibration: Logistic
    #: The score of a text without any term or neighbour.
    rest: float

    def score(self, texts: list[bytes]) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """Score, neighbours and cosines of each text."""
        for rows, cosines in self.index.nearest(*term_counts(texts, self.index.terms), len(texts)):
            votes = np.asarray([self.index.vote(rows, cosines)]) if len(rows) else None
            yield self.rest if votes is None else float(self.calibration.predict(votes)[0]), rows, cosines


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", sample: int = SAMPLE) -> Model:
    """The model of a bounded sample: the driver gets the hashed terms and their counts of about sample texts, once, and how many documents hold each."""
    spark = docs.sparkSession
    texts = documents(docs, "doc_id", "text")
    chosen = texts.join(F.broadcast(learnt(labels, column, sample)), "doc_id")  # at most about `sample` rows of two numbers
    listed = "doc_id long, y int, terms array<long>, counts array<int>"

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in text_slices(batches):
            text, terms, n = term_counts(raw)
            offsets = pa.array(np.searchsorted(text, np.arange(len(raw) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (terms.view(np.int64), n.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), *lists], names=["doc_id", "y", "terms", "counts"])

    found = stored(chosen.select("doc_id", "y", "text").mapInArrow(vectors, listed), "examples")
    got = found.orderBy("doc_id", "terms", "counts").toArrow().combine_chunks()
    sizes = pc.list_value_length(got.column("terms")).to_numpy()
    flat = lambda c: pc.list_flatten(got.column(c)).to_numpy()
    terms, places = np.unique(flat("terms").view(np.uint64), return_inverse=True)
    known = spark.sparkContext.broadcast(pack(terms))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = unpack(known.value, np.uint64)
        n = np.zeros(len(there), np.int64)
        for _, raw in text_slices(batches):
            n += np.bincount(term_counts(raw, there)[1], minlength=len(there))
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n[held])], names=["place", "n"])

    counts = texts.select("text").mapInArrow(spread, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    df = np.ones(len(terms))
    df[counts.column("place").to_numpy()] = counts.column("n").to_numpy()
    idf = np.log((1 + docs.count()) / (1 + df)) + 1
    ys = np.minimum(1, got.column("y").to_numpy()).astype(np.int64)
    some = np.flatnonzero(sizes > 0)
    now = np.full(len(sizes), -1)
    now[some] = np.arange(len(some))
    index = Index.of(terms, idf, got.column("doc_id").to_numpy()[some], ys[some], now[np.repeat(np.arange(len(sizes)), sizes)], places, flat("counts"))
    bare = ys[sizes == 0]
    shared = spark.sparkContext.broadcast(index)

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            lists, votes, ys = batch.column("terms"), [], []
            text = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy())
            at = np.searchsorted(index.terms, pc.list_flatten(lists).to_numpy().view(np.uint64))
            found = index.nearest(text, at, pc.list_flatten(batch.column("counts")).to_numpy(), len(batch), without=batch.column("doc_id").to_pylist())
            for (near, cosines), y in zip(found, batch.column("y").to_pylist(), strict=True):
                if len(near):
                    votes.append(index.vote(near, cosines))
                    ys.append(min(1, y))
            yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in votes], pa.float64()), pa.array([c for _, c in votes], pa.float64()), pa.array(ys, pa.float64())], names=["vote", "cosine", "y"])

    votes = found.where(F.size("terms") > 0).mapInArrow(left_out, "vote double, cosine double, y double").orderBy("vote", "cosine", "y").toPandas()
    y = votes["y"].to_numpy()
    # Platt's targets keep the scores of a clean split off 0 and 1.
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    calibration = Logistic.fit(votes[["vote", "cosine"]].to_numpy(), target)
    # Twenty texts without terms are assumed, one of them labelled.
    return Model(index, calibration, float((1 + bare.sum()) / (20 + len(bare))))


def score_documents(docs: DataFrame, model: Model, evidence: int = 3) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence (the nearest examples) of every document.

    score (0 to 1) is the calibrated vote; a text without any term of the model, like an empty or
    null one, gets the share of labelled texts among the examples without terms. The whole text
    is read. Rows with the same or no doc_id are scored each; an id of null is not held out.
    evidence lists doc_id, cosine and label of up to that many neighbours; an example that is the
    document itself stands among them if it was learnt from. An empty table gives no rows; without
    labels all scores are equal. The model is broadcast: all terms of about SAMPLE examples at most.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = documents(docs, "doc_id", "text").withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    near = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        index = model.index
        known: dict[bytes, tuple] = {}
        for batch, raw in text_slices(batches):
            keys = [hashlib.blake2b(text, digest_size=16).digest() for text in raw]
            new = {k: t for k, t in zip(keys, raw, strict=True) if k not in known}
            fresh = {}
            for key, (s, rows, cosines) in zip(new, model.score(list(new.values())), strict=True):
                fresh[key] = s, [{"doc_id": int(index.ids[r]), "cosine": float(c), "label": int(index.labels[r])} for r, c in zip(rows[:evidence], cosines, strict=False)]
            out = [fresh[k] if k in fresh else known[k] for k in keys]
            for key, value in fresh.items():
                if len(known) < MEMORY:
                    known[key] = value
            array = np.asarray([s for s, _ in out])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(array), pa.array((array >= 0.5).astype(np.int32)), pa.array([e for _, e in out], near)], names=["doc_id", "held_out", "score", "predicted", "evidence"])

    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int, evidence array<struct<doc_id:long,cosine:double,label:int>>")
