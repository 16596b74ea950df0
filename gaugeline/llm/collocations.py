"""Phrase collocations by best-first branch and bound over growing phrases.

A phrase grows to the right. What a prefix has been counted for bounds the score of everything that
begins with it, so only prefixes whose bound reaches the score to beat are grown, and counted in
one pass over the texts. The score to beat starts at a good bigram's, and is lowered until every
language has as many surviving phrases at or above it as are asked for: then nothing unseen can
come before them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import mix, stored, text_slices, word_hashes
from gaugeline.llm.tokens import Words, filter_of, passes, signed, words_of

#: Phrases asked for in each language, and how often a candidate occurs at least.
TOP, LEAST = 2000, 30
#: The score to beat at first: of this many times TOP bigrams the last one's; four times as many in each further round.
SLACK = 2
#: A longer candidate this often as frequent (in percent) takes a candidate's place.
COVER = 80
#: Fixed value: the score of a phrase whose parts occur only in it, times two.
SCALE = 2_000_000

_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)
_INSIDE = np.ones(256, bool)
_INSIDE[[0x20, 0x09, 0x0A]] = False
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _then(code: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The code of a phrase that goes on with a word."""
    return mix(code * _ODD + word)


def _read(batch: pa.RecordBatch, texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """The words, the piece and the key (of word and language) of each, and the languages with each text's."""
    blob = b"\n".join(texts).translate(_TABLE)
    words = words_of(texts, blob, _INSIDE)
    langs = batch.column("lang").dictionary_encode()
    names = [x.encode() for x in langs.dictionary.to_pylist()]
    of_text = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pieces = np.cumsum(np.frombuffer(blob, np.uint8) == 0x0A)
    keys = mix(words.hashes[words.ids] + mix(word_hashes(names))[of_text[words.text]]) if len(words.ids) else np.zeros(0, np.uint64)
    return words, pieces[words.starts] if len(words.starts) else np.zeros(0, np.int64), keys, names, of_text


def count_words(rows: DataFrame) -> DataFrame:
    """(key, lang, word, n) of all words of rows (lang, text)."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            words, _, keys, names, of_text = _read(batch, texts)
            unique, first, n = np.unique(keys, return_index=True, return_counts=True)
            lang = [names[k] for k in of_text[words.text[first]].tolist()]
            yield pa.RecordBatch.from_arrays([signed(unique), pa.array(lang, pa.binary()), pa.array([words.names[k] for k in words.ids[first].tolist()], pa.binary()), pa.array(n)], names=["key", "lang", "word", "n"])

    got = rows.mapInArrow(counted, "key long, lang binary, word binary, n long")
    got = got.groupBy("key", "lang", "word").agg(F.sum("n").alias("n"))
    return got.select("key", F.col("lang").cast("string").alias("lang"), F.col("word").cast("string").alias("word"), "n")


def count_phrases(rows: DataFrame, length: int, wanted: Callable[[list[np.ndarray]], np.ndarray]) -> DataFrame:
    """(code, the codes or keys in names, n) of all phrases of length words that wanted lets through.

    wanted gets, for every phrase in a slice, codes[b - 1][a:] shaped arrays: see _codes. Counts are
    exact for the phrases let through.
    """
    names = {1: ["code"], 2: ["code", "w1", "w2"], 3: ["code", "c12", "c23"], 4: ["code", "c123", "c234", "c34"]}[length]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            _, pieces, keys, _, _ = _read(batch, texts)
            there = max(0, len(keys) - length + 1)
            words = [keys[k : k + there] for k in range(length)]
            whole = np.flatnonzero(pieces[:there] == pieces[length - 1 : length - 1 + there]) if there else np.zeros(0, np.int64)
            words = [w[whole] for w in words]
            parts = _codes(words)
            keep = wanted(parts)
            parts = [p[keep] for p in parts]
            code, first, n = np.unique(parts[0], return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([signed(code), *[signed(p[first]) for p in parts[1:]], pa.array(n)], names=[*names, "n"])

    got = rows.mapInArrow(counted, ", ".join(f"{c} long" for c in [*names, "n"]))
    return got.groupBy(*names).agg(F.sum("n").alias("a")).where(F.col("a") >= LEAST)


def _codes(words: list[np.ndarray]) -> list[np.ndarray]:
    """A phrase's code, and those of its parts: of two words both, of three the two bigrams, of four the two trigrams and the last bigram."""
    code = lambda ws: reduce(_then, ws)
    if len(words) == 2:
        return [code(words), *words]
    if len(words) == 3:
        return [code(words), code(words[:2]), code(words[1:])]
    return [code(words), code(words[:3]), code(words[1:]), code(words[2:])]


def _score(a: Column, *cuts: tuple[Column, Column]) -> Column:
    """(score, k, l, r) of the lowest cut; decimals, as products may pass 64 bits."""
    def cut(k: int, left: Column, right: Column) -> Column:
        value = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * a.cast("decimal(19,0)"), (left + right).cast("decimal(20,0)"))
        return F.struct(value.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))

    made = [cut(k, *c) for k, c in enumerate(cuts, 1)]
    return F.least(*made) if len(made) > 1 else made[0]


def _bound(a: Column, most: Column, first: Column) -> Column:
    """No phrase that begins with this prefix scores more: it occurs at most m = min(a, most) times, its rest at least as often as itself, and m / (first + m) grows with m."""
    m = F.least(a, most)
    return F.coalesce(F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * m.cast("decimal(19,0)"), (first + m).cast("decimal(20,0)")), F.lit(0))


def mined(docs: DataFrame, top: int = TOP, slack: int = SLACK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first top phrases of each language.

    docs: lang and text; other columns don't matter. A null lang is ``und``, a null text is empty; texts
    without words count nothing, repeated rows count as often as they are. Phrases equal in score
    and count are ordered by their bytes. An empty table gives no rows, as do languages without a
    phrase of LEAST occurrences. Words and phrases are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    words = stored(count_words(rows), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= LEAST)
    share = spark.sparkContext.broadcast
    known = share(filter_of(frequent, "key"))
    pairs = count_phrases(rows, 2, lambda c: passes(known.value, c[1]) & passes(known.value, c[2]))
    one = frequent.select("key", "lang", F.col("n").alias("f"))
    both = pairs.join(one.withColumnsRenamed({"key": "w1", "f": "f1"}), "w1").join(one.select(F.col("key").alias("w2"), F.col("f").alias("f2")), "w2")
    both = both.select("code", "lang", "w1", "w2", "a", "f1", "f2", _score(F.col("a"), (F.col("f1"), F.col("f2"))).alias("s"))
    both = stored(both, "bigrams")
    follow = both.groupBy(F.col("w1").alias("w2")).agg(F.max("a").alias("most"))
    two = stored(both.join(follow, "w2", "left").select("code", "lang", "w1", "w2", "a", "f1", "f2", "s", _bound(F.col("a"), F.coalesce("most", F.lit(0)), F.col("f1")).alias("bound")), "bigrams")
    all_pairs = share(filter_of(two, "code"))
    beaten = None
    while True:
        beat = _beat(two, top * slack) if beaten is None else stored(_lower(two, beaten, top * slack), "beat")
        found = _grown(rows, two, beat, all_pairs.value)
        # Settled: enough survivors at or above the score to beat, or nothing below it.
        beat = stored(beat.join(found.groupBy("lang").agg(F.count("*").alias("there")), "lang", "left").withColumn("settled", (F.coalesce("there", F.lit(0)) >= top) | (F.col("beat") <= 0)).drop("there"), "beat")
        if not beat.where("NOT settled").limit(1).count():
            break
        beaten, slack = beat, slack * 4
    for w in range(1, 5):
        found = found.join(frequent.select(F.col("key").alias(f"w{w}"), F.col("word").alias(f"t{w}")), f"w{w}", "left")
    phrase = F.concat_ws(" ", *[f"t{w}" for w in range(1, 5)])
    found = found.select("lang", phrase.alias("phrase"), "a", "s.l", "s.r", F.col("s.score").alias("score"))
    by = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(by).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _beat(two: DataFrame, many: int) -> DataFrame:
    """(lang, beat): the score of the many-th best bigram; 0 where there are fewer."""
    ranked = two.select("lang", "s.score", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("s.score").desc())).alias("k")).where(F.col("k") <= many)
    return stored(ranked.groupBy("lang").agg(F.when(F.max("k") >= many, F.min("score")).otherwise(F.lit(0)).alias("beat")), "beat")


def _lower(two: DataFrame, beaten: DataFrame, many: int) -> DataFrame:
    """The next score to beat of languages that aren't settled."""
    fresh = _beat(two, many).withColumnRenamed("beat", "next")
    return beaten.join(fresh, "lang").select("lang", F.when(F.col("settled"), F.col("beat")).otherwise(F.least("beat", "next")).alias("beat"))


def _grown(rows: DataFrame, two: DataFrame, beat: DataFrame, all_pairs: np.ndarray) -> DataFrame:
    """All phrases (lang, w1 to w4, a, s) that reach their language's score to beat and that no longer candidate covers.

    Grown to the right are prefixes whose bound reaches it; counted to both sides are phrases that
    reach it themselves, as a longer candidate may cover them.
    """
    share = rows.sparkSession.sparkContext.broadcast
    two = two.join(beat.select("lang", "beat"), "lang")
    score, reach = F.col("s.score"), F.col("s.score") >= F.col("beat")
    open2 = share((filter_of(two.where(reach | (F.col("bound") >= F.col("beat"))), "code"), filter_of(two.where(reach), "code"), all_pairs))

    def three_wanted(c: list[np.ndarray]) -> np.ndarray:
        grown, reached, frequent = open2.value
        return passes(frequent, c[1]) & passes(frequent, c[2]) & (passes(grown, c[1]) | passes(reached, c[2]))

    left = two.select(F.col("code").alias("c12"), "lang", "beat", "w1", "w2", F.col("a").alias("f12"), "f1")
    right = two.select(F.col("code").alias("c23"), F.col("w2").alias("w3"), F.col("a").alias("f23"), F.col("f2").alias("f3"))
    most = two.groupBy(F.col("w1").alias("w3")).agg(F.max("a").alias("most"))

    def scored(counts: DataFrame) -> DataFrame:
        got = counts.join(left, "c12").join(right, "c23").join(most, "w3", "left")
        s = _score(F.col("a"), (F.col("f1"), F.col("f23")), (F.col("f12"), F.col("f3")))
        return got.select("code", "lang", "beat", "w1", "w2", "w3", "c12", "c23", "a", "f1", "f12", s.alias("s"), _bound(F.col("a"), F.coalesce("most", F.lit(0)), F.col("f1")).alias("bound"))

    three = stored(scored(count_phrases(rows, 3, three_wanted)), "trigrams")
    open3 = share((filter_of(three.where(reach | (F.col("bound") >= F.col("beat"))), "code"), filter_of(three.where(reach), "code"), all_pairs))

    def four_wanted(c: list[np.ndarray]) -> np.ndarray:
        grown, reached, frequent = open3.value
        return passes(frequent, c[3]) & (passes(grown, c[1]) | passes(reached, c[2]))

    four = stored(count_phrases(rows, 4, four_wanted), "fourgrams")
    # A phrase of four words is a candidate of its own only if its prefix was grown; its last three words may not have been counted yet.
    own = four.join(three.select(F.col("code").alias("c123"), "lang", "beat", "w1", "w2", "w3", F.col("a").alias("f123"), "f1", "f12", "bound"), "c123").where(F.col("bound") >= F.col("beat"))
    own = own.join(two.select(F.col("code").alias("c34"), F.col("w2").alias("w4"), F.col("a").alias("f34"), F.col("f2").alias("f4")), "c34").drop("bound")
    rest = own.select(F.col("c234").alias("code")).distinct()
    unknown = stored(rest.join(three.select("code"), "code", "left_anti"), "uncounted")
    tail = three.select(F.col("code").alias("c234"), F.col("a").alias("f234"))
    if unknown.limit(1).count():
        asked = share(filter_of(unknown, "code"))
        more = count_phrases(rows, 3, lambda c: passes(asked.value, c[0])).join(unknown, "code")
        tail = tail.unionByName(more.select(F.col("code").alias("c234"), F.col("a").alias("f234")))
    own = own.join(tail, "c234")
    own = own.withColumn("s", _score(F.col("a"), (F.col("f1"), F.col("f234")), (F.col("f12"), F.col("f34")), (F.col("f123"), F.col("f4"))))

    def uncovered(phrases: DataFrame, longer: DataFrame, *sides: str) -> DataFrame:
        over = reduce(DataFrame.unionByName, [longer.select(F.col(c).alias("code"), F.col("a").alias("longer")) for c in sides])
        over = over.groupBy("code").agg(F.max("longer").alias("longer"))
        kept = phrases.where(reach).join(over, "code", "left")
        big = lambda c: F.col(c).cast("decimal(19,0)")
        return kept.where(F.col("longer").isNull() | (100 * big("longer") < COVER * big("a")))

    none = F.lit(None).cast("long")
    two_left = uncovered(two, three, "c12", "c23").select("lang", "w1", "w2", none.alias("w3"), none.alias("w4"), "a", "s")
    three_left = uncovered(three, four, "c123", "c234").select("lang", "w1", "w2", "w3", none.alias("w4"), "a", "s")
    four_left = own.where(score >= F.col("beat")).select("lang", "w1", "w2", "w3", "w4", "a", "s")
    return stored(two_left.unionByName(three_left).unionByName(four_left), "phrases")
