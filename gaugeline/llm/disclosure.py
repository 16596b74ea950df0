"""Personal data, and the words that give it away: information-theoretic sanitisation.

Patterns find emails, addresses, cards and phones. Every value found is an entity. Words near an
entity are counted over the corpus: a word discloses an entity if its pointwise mutual information
with it is at least STRENGTH of the entity's own information, -log p. Disclosing words are
generalised to their beginning, or removed where the beginning discloses as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import documents, stored, text_slices, word_hashes
from gaugeline.llm.tokens import Words, filter_of, passes, signed, words_of

KINDS = ("email", "ip", "card", "phone")
#: Words to each side of an entity that count as near it.
WINDOW = 10
#: Different texts that hold an entity, and an entity with a word near it, at least.
SUPPORT = 3
#: An entity in a larger share of all documents carries too little information to be protected from inference.
PUBLIC = 0.01
#: Disclosing: PMI(entity, word) >= 3/4 of -log p(entity).
STRENGTH = (3, 4)
#: Letters that a word's generalisation keeps.
BEGINNING = 4

_LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# The contract's patterns; possessive where nothing can be given back, so that long runs are read once.
_DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(rb"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(rb"[0-9]")

_INSIDE = np.zeros(256, bool)
_INSIDE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_INSIDE[0x80:] = True

Span = tuple[int, int, int, bytes]


def _emails(text: bytes) -> Iterator[tuple[int, int]]:
    """Around every @: the run before it, never read twice, and the domain after it."""
    end = last = 0
    at = text.find(b"@")
    while at >= 0:
        low = max(end, last)
        start = low + len(text[low:at].rstrip(_LOCAL))
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        last = at + 1
        at = text.find(b"@", last)


def _digits(found: bytes) -> bytes:
    return found.translate(None, b" ().+-")


def luhn(digits: bytes) -> bool:
    twice = [2 * d - 9 * (d > 4) for d in (c - 48 for c in digits[-2::-2])]
    return (sum(c - 48 for c in digits[::-2]) + sum(twice)) % 10 == 0


def base_spans(text: bytes) -> list[Span]:
    """(kind, start, end, entity) of the patterns' valid matches, in bytes; by kind, then start."""
    out: list[Span] = []
    if b"@" in text:
        out += [(0, s, e, text[s:e].lower()) for s, e in _emails(text)]
    if _DIGIT.search(text) is None:
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip(b"0")) <= 3 and int(p.lstrip(b"0") or b"0") <= 255 for p in m.group().split(b".")):
            out.append((1, m.start(), m.end(), m.group()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append((2, m.start(), m.end(), d))
    if b"+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(d := _digits(m.group())) <= 15:
                out.append((3, m.start(), m.end(), d))
    return out


def _points(text: bytes) -> np.ndarray:
    """For every byte offset how many code points come before it."""
    return np.r_[0, np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)]


def _covered(starts: np.ndarray, ends: np.ndarray, spans: list[Span]) -> np.ndarray:
    """Which words overlap a span."""
    merged: list[list[int]] = []
    for s, e in sorted((s, e) for _, s, e, _ in spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(e, merged[-1][1])
        else:
            merged.append([s, e])
    if not merged:
        return np.zeros(len(starts), bool)
    low, high = np.asarray(merged).T
    k = np.searchsorted(high, starts, side="right")
    return (k < len(low)) & (np.append(low, np.iinfo(np.int64).max)[k] < ends)


def _words(texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words in lower case, each text's offset, and for each distinct word its beginning's hash and whether it has one."""
    words = words_of(texts, b"\n".join(texts).lower(), _INSIDE)
    offsets = np.cumsum([0, *[len(t) + 1 for t in texts]])
    names = [n.decode("utf-8", "replace") for n in words.names]
    long = np.fromiter((len(n) > BEGINNING for n in names), bool, len(names))
    begin = np.zeros(len(names), np.uint64)
    begin[long] = word_hashes([n[:BEGINNING].encode() + b"*" for n in names if len(n) > BEGINNING])
    return words, offsets, begin, long


_FOUND = "doc_id long, text_key string, base array<struct<kind:int,start:int,end:int>>, near array<struct<entity:long,terms:array<long>>>"


def scanned(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_key, base (the patterns' spans, in code points), near (the hashed words and beginnings near each entity)."""
    base_kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    near_kind = pa.list_(pa.struct([("entity", pa.int64()), ("terms", pa.list_(pa.int64()))]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            spans = [base_spans(t) for t in texts]
            bases: list[list] = [[] for _ in texts]
            nears: list[list] = [[] for _ in texts]
            with_some = [k for k, s in enumerate(spans) if s]
            if with_some:
                held = [texts[k] for k in with_some]
                words, offsets, begin, long = _words(held)
                edges = np.searchsorted(words.text, np.arange(len(held) + 1))
                for place, k in enumerate(with_some):
                    points = _points(texts[k])
                    bases[k] = [{"kind": c, "start": int(points[s]), "end": int(points[e])} for c, s, e, _ in spans[k]]
                    here = slice(edges[place], edges[place + 1])
                    starts, ends, ids = words.starts[here] - offsets[place], words.ends[here] - offsets[place], words.ids[here]
                    free = ~_covered(starts, ends, spans[k])
                    beside: dict[bytes, list[np.ndarray]] = {}
                    for c, s, e, entity in spans[k]:
                        before, after = np.searchsorted(ends, s, side="right"), np.searchsorted(starts, e)
                        at = np.r_[max(0, before - window) : before, after : min(len(ids), after + window)]
                        beside.setdefault(b"%d:%s" % (c, entity), []).append(ids[at[free[at]]])
                    hashed = word_hashes(list(beside)).view(np.int64)
                    for entity, lists in zip(hashed.tolist(), beside.values(), strict=True):
                        seen = np.unique(np.concatenate(lists))
                        terms = np.unique(np.r_[words.hashes[seen], begin[seen[long[seen]]]])
                        nears[k].append({"entity": entity, "terms": terms.view(np.int64).tolist()})
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(bases, base_kind), pa.array(nears, near_kind)], names=["doc_id", "text_key", "base", "near"])

    return docs.mapInArrow(scan, _FOUND)


def _counted(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(term, n): in how many documents the words and beginnings in a filter occur."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches):
            words, _, begin, long = _words(texts)
            of_word, of_begin = passes(shared.value, words.hashes), passes(shared.value, begin) & long
            first = of_word[words.ids]
            second = of_begin[words.ids]
            terms = np.r_[words.hashes[words.ids[first]], begin[words.ids[second]]]
            unique, codes = np.unique(terms, return_inverse=True)
            pairs = np.unique(codes * np.int64(len(texts) + 1) + np.r_[words.text[first], words.text[second]])
            n = np.bincount(pairs // (len(texts) + 1), minlength=len(unique))
            yield pa.RecordBatch.from_arrays([signed(unique), pa.array(n)], names=["term", "n"])

    return docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_term"))


def disclosing(docs: DataFrame, found: DataFrame, support: int = SUPPORT, public: float = PUBLIC) -> DataFrame:
    """(term): hashes of words and beginnings that disclose an entity. docs: text; found: scanned() of them.

    PMI(c, t) = log(N n(c,t) / (n(c) n(t))) is at least 3/4 of log(N / n(c)) just if
    N n(c,t)^4 >= n(c) n(t)^4. n counts documents, n(c,t) those with t near c.
    """
    whole = docs.count()
    near = found.where(F.size("near") > 0).select("text_key", F.explode("near").alias("e")).select("text_key", "e.entity", "e.terms")
    # By text first, so that an entity of very many documents is counted in many tasks.
    per_text = near.groupBy("entity", "text_key").agg(F.count("*").alias("n"))
    entities = per_text.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count("*").alias("texts"))
    entities = stored(entities.where((F.col("texts") >= support) & (F.col("n_entity") <= public * whole)).drop("texts"), "entities")
    pairs = near.join(entities, "entity").select("entity", "n_entity", "text_key", F.explode("terms").alias("term"))
    pairs = pairs.groupBy("entity", "n_entity", "term", "text_key").agg(F.count("*").alias("n")).groupBy("entity", "n_entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("texts"))
    pairs = stored(pairs.where(F.col("texts") >= support), "pairs")
    met = pairs.join(_counted(docs, filter_of(pairs, "term")), "term")
    k, m = STRENGTH
    factors = lambda c, n: [F.col(c).cast("double")] * n
    times = lambda xs: reduce(lambda a, b: a * b, xs)
    strong = times([F.lit(float(whole))] * (m - k) + factors("n_both", m)) >= times(factors("n_entity", m - k) + factors("n_term", m))
    return stored(met.where(strong).select("term").distinct(), "disclosing")


def _hits(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(text_key, start, end, term, beginning) of words in a filter that no base span covers, in code points; beginning is null for short words."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            words, offsets, begin, long = _words(texts)
            at = np.flatnonzero(passes(shared.value, words.hashes)[words.ids])
            edges = np.searchsorted(words.text[at], np.arange(len(texts) + 1))
            kept, starts, ends = [], [], []
            for k in np.flatnonzero(np.diff(edges)).tolist():
                here = at[edges[k] : edges[k + 1]]
                here = here[~_covered(words.starts[here] - offsets[k], words.ends[here] - offsets[k], base_spans(texts[k]))]
                points = _points(texts[k])
                kept.append(here)
                starts.append(points[words.starts[here] - offsets[k]])
                ends.append(points[words.ends[here] - offsets[k]])
            joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
            here = joined(kept)
            ids = words.ids[here]
            keys = batch.column("text_key").take(pa.array(words.text[here]))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(joined(starts).astype(np.int32)), pa.array(joined(ends).astype(np.int32)), signed(words.hashes[ids]), pa.array(begin[ids].view(np.int64), mask=~long[ids])],
                names=["text_key", "start", "end", "term", "beginning"],
            )

    return docs.select("text_key", "text").mapInArrow(hit, "text_key string, start int, end int, term long, beginning long").distinct()


def find(docs: DataFrame, window: int = WINDOW, support: int = SUPPORT, public: float = PUBLIC) -> DataFrame:
    """doc_id, text_key (md5 of the text), base (kind, start, end) and terms (start, end, removed) of every document.

    Offsets are code points, end exclusive; base is in the order of KINDS, then by start. terms are
    words that disclose an entity which their own text may not even hold; removed says that their
    beginning discloses too, or that they are too short to have one. A null text is empty. Rows of
    the same or no doc_id are searched each; equal texts get equal spans. An empty table gives no rows.
    Words, beginnings and entities are told apart by 64-bit hashes.
    """
    rows = documents(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.md5("text"))
    found = stored(scanned(rows, window), "private")
    strong = disclosing(rows, found, support, public)
    hits = _hits(rows, filter_of(strong, "term")).join(strong, "term")
    general = strong.select(F.col("term").alias("beginning"), F.lit(True).alias("also"))
    hits = hits.join(general, "beginning", "left").select("text_key", F.struct("start", "end", (F.col("beginning").isNull() | F.col("also").isNotNull()).alias("removed")).alias("t"))
    terms = hits.groupBy("text_key").agg(F.array_sort(F.collect_list("t")).alias("terms"))
    out = found.drop("near").join(terms, "text_key", "left")
    none = F.expr("CAST(array() AS array<struct<start:int,end:int,removed:boolean>>)")
    return out.select("doc_id", "text_key", "base", F.coalesce("terms", none).alias("terms"))


def listed(base: Column, terms: Column | None = None) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    line = lambda kind, s: F.concat(kind, F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))
    parts = F.transform(base, lambda s: line(names[s["kind"]], s))
    if terms is not None:
        parts = F.concat(parts, F.transform(terms, lambda s: line(F.lit("term"), s)))
    return F.array_join(parts, ",")


def sanitised(docs: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The documents with their columns, texts without what find() found: entities become ``<kind>``, words their
    beginning and a star, or nothing. Where spans overlap, all of what they cover becomes the first one's."""
    found = find(docs) if found is None else found
    edits = found.where((F.size("base") > 0) | (F.size("terms") > 0)).select(F.col("text_key").alias("_key"), F.col("base").alias("_base"), F.col("terms").alias("_terms")).dropDuplicates(["_key"])
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    rows = rows.withColumn("_mine", F.md5("_text")).join(edits, F.col("_mine") == F.col("_key"), "left").select("_row", "_text", "_base", "_terms")
    whole = rows.schema["_row"].dataType.simpleString()

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, base, terms in zip(*(batch.column(c).to_pylist() for c in ("_text", "_base", "_terms")), strict=True):
                changes = [(s["start"], s["end"], f"<{KINDS[s['kind']]}>") for s in base or ()]
                changes += [(s["start"], s["end"], "" if s["removed"] else text[s["start"] : s["start"] + BEGINNING] + "*") for s in terms or ()]
                parts, at = [], 0
                for start, end, word in sorted(changes):
                    if start >= at:
                        parts += (text[at:start], word)
                    at = max(at, end)
                out.append("".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(out, pa.string())], names=["_row", "_clean"])

    clean = rows.mapInArrow(rewrite, f"_row {whole}, _clean string")
    return clean.select(*[F.when(F.col("_row.text").isNotNull(), F.col("_clean")).alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
