"""Document fingerprints by I-Match, with DataFrame functions only.

The lexicon holds the terms whose inverse document frequency lies in a band. A document keeps its
distinct terms of the lexicon, sorted; each of several randomised subsets of the lexicon gives one
hash of those that it holds. Two fingerprints are alike as far as their hashes agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import documents, stored

#: Terms of the lexicon are in this share of all documents: neither rare nor everywhere.
BAND = (0.005, 0.02)
#: One subset for each entry: a term is in it with this chance, in 256ths.
SUBSETS = (16,) * 8 + (4,) * 16 + (1,) * 8
#: Hex digits of a subset's hash.
DIGITS = 6
#: A lexicon of up to as many terms is broadcast.
BROADCAST_TERMS = 200_000
#: Ids next to each other that one window sorts.
NEIGHBOURHOOD = 1024

_SPACE = "[\\x20\\x09-\\x0D]+"


def terms(text: Column) -> Column:
    """The distinct words of a text in lower case, and the empty word, which every text has."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.lower(text), _SPACE)))


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """(term, mask): the terms of the band over all documents; mask has a bit for each subset that holds the term.

    Its size is bounded: there are at most (distinct terms of a mean document) / band[0] such terms.
    """
    counts = docs.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    whole = docs.count()
    held = counts.where((F.col("term") != "") & (F.col("df") >= band[0] * whole) & (F.col("df") <= band[1] * whole)).select("term")
    chance = lambda k: F.conv(F.substring(F.md5(F.concat(F.lit(f"{k}:"), F.col("term"))), 1, 2), 16, 10).cast("int")
    bits = [F.when(chance(k) < share, F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, share in enumerate(SUBSETS)]
    masked = held.select("term", reduce(lambda a, b: a.bitwiseOR(b), bits).alias("mask"))
    empty = docs.sparkSession.createDataFrame([("", 0)], "term string, mask long")
    return stored(masked.unionByName(empty), "lexicon")


def _fingerprint(found: Column, text_key: Column) -> Column:
    """A hash for each subset, dashes where it is empty; a text with none has a hash of itself instead."""
    held = lambda k: F.filter(found, lambda t: F.getbit(t["mask"], k) == 1)
    texts = F.transform(F.sequence(F.lit(0), F.lit(len(SUBSETS) - 1)), lambda k: F.array_join(F.transform(held(k), lambda t: t["term"]), " "))
    parts = F.transform(texts, lambda s: F.when(s == "", F.lit("-" * DIGITS)).otherwise(F.substring(F.md5(s), 1, DIGITS)))
    return F.coalesce(F.nullif(F.array_join(parts, ""), F.lit("-" * (DIGITS * len(SUBSETS)))), F.concat(F.lit("="), text_key))


def alike(a: Column, b: Column) -> Column:
    """The share of equal hashes among the subsets that are not empty in both; 1 for equal fingerprints, 0 if a text has none of the lexicon."""
    def agree(x: Column, y: Column) -> Column:
        parts = lambda c: F.transform(F.sequence(F.lit(0), F.lit(len(SUBSETS) - 1)), lambda k: F.substring(c, k * DIGITS + 1, F.lit(DIGITS)))
        pairs = F.filter(F.arrays_zip(parts(x).alias("x"), parts(y).alias("y")), lambda p: (p["x"] != "-" * DIGITS) | (p["y"] != "-" * DIGITS))
        return F.size(F.filter(pairs, lambda p: p["x"] == p["y"])) / F.size(pairs)

    return F.when(a == b, 1.0).when(a.startswith("=") | b.startswith("="), 0.0).otherwise(agree(a, b))


def fingerprinted(texts: DataFrame, names: tuple[str, ...], lexicon_: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """doc_id, key, the keep columns, and a fingerprint column for each text column in names.

    texts: doc_id and key, which together tell rows apart (equal rows become one), the keep columns
    and the text columns. The texts stay where they are; only their terms of the lexicon move.
    """
    sets = F.array(*[F.struct(F.lit(v).alias("v"), F.md5(n).alias("hash"), terms(F.col(n)).alias("terms")) for v, n in enumerate(names)])
    rows = texts.select("doc_id", "key", *keep, F.explode(sets).alias("s")).select("doc_id", "key", *keep, "s.v", "s.hash", F.explode("s.terms").alias("term"))
    # What belongs to a row travels with its empty word only.
    with_it = lambda c: F.when(F.col("term") == "", F.col(c)).alias(c)
    rows = rows.select("doc_id", "key", *[with_it(c) for c in keep], "v", with_it("hash"), "term")
    rows = rows.join(F.broadcast(lexicon_) if lexicon_.count() <= BROADCAST_TERMS else lexicon_, "term")
    one = F.struct("term", "mask")
    lists = [F.collect_list(F.when((F.col("v") == v) & (F.col("term") != ""), one)).alias(f"_{v}") for v in range(len(names))]
    keys = [F.max(F.when(F.col("v") == v, F.col("hash"))).alias(f"_h{v}") for v in range(len(names))]
    grouped = rows.groupBy("doc_id", "key").agg(*[F.max(c).alias(c) for c in keep], *lists, *keys)
    sorted_ = {f"_{v}": F.array_sort(F.array_distinct(f"_{v}")) for v in range(len(names))}
    # Sorted once: written, as the optimizer would otherwise move the sort into the lambda over all subsets.
    grouped = stored(grouped.withColumns(sorted_), "terms")
    prints = [_fingerprint(F.col(f"_{v}"), F.col(f"_h{v}")).alias(n) for v, n in enumerate(names)]
    return grouped.select("doc_id", "key", *keep, *prints)


def successors(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) of distinct ids, the largest followed by the smallest; windows hold at most NEIGHBOURHOOD ids each,
    but for one over a row for each NEIGHBOURHOOD squared."""
    def follow(ids: DataFrame, depth: int) -> DataFrame:
        if not depth:
            return ids.withColumn("next_id", F.lead("doc_id").over(Window.orderBy("doc_id")))
        ids = ids.withColumn("_b", F.floor(F.col("doc_id") / NEIGHBOURHOOD).cast("long"))
        firsts = ids.groupBy("_b").agg(F.min("doc_id").alias("first"))
        after = follow(firsts.select(F.col("_b").alias("doc_id")), depth - 1).select(F.col("doc_id").alias("_b"), F.col("next_id").alias("_after"))
        after = after.join(firsts.select(F.col("_b").alias("_after"), "first"), "_after", "left").select("_b", "first")
        inside = F.lead("doc_id").over(Window.partitionBy("_b").orderBy("doc_id"))
        return ids.withColumn("_next", inside).join(after, "_b", "left").select("doc_id", F.coalesce("_next", "first").alias("next_id"))

    least = ids.agg(F.min("doc_id")).first()[0]
    return follow(ids, 2).withColumn("next_id", F.coalesce("next_id", F.lit(least).cast("long")))


def compare_edited(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    The edited text ends in the first floor(n_chars / 2) code points of the next document, by
    ascending doc_id, instead of its own last as many; after the largest id comes the smallest. Null texts
    are empty. Rows of the same doc_id are edited each with the least text of the next id, and
    compared with its least fingerprint; equal rows stay as many as they are. A row without
    doc_id has no next document: its last half is cut off, and near_next is null. Equal texts have
    equal fingerprints; a text without terms of the lexicon resembles only its equals.
    """
    docs = documents(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = lexicon(docs, band)
    ids = docs.select("doc_id").where("doc_id IS NOT NULL")
    nexts = stored(successors(ids.distinct()), "next")
    alone = nexts.count() == docs.count()  # no repeated ids, none missing
    half = F.floor(F.length("text") / 2).cast("int")
    needs = docs.select("doc_id", half.alias("need"))
    needs = needs if alone else needs.groupBy("doc_id").agg(F.max("need").alias("need"))
    asked = nexts.join(needs, "doc_id").select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("for_id"), "need")
    heads = docs.join(asked, "doc_id").select(F.col("for_id").alias("doc_id"), F.substring("text", F.lit(1), F.col("need")).alias("head"))
    heads = heads if alone else heads.groupBy("doc_id").agg(F.min("head").alias("head"))
    both = docs.join(heads, "doc_id", "inner" if alone else "left")
    begin = F.substring("text", F.lit(1), F.length("text") - half)
    edited = both.select("doc_id", F.xxhash64("text").alias("key"), "text", F.concat(begin, F.substring(F.coalesce("head", F.lit("")), F.lit(1), half)).alias("edited"))
    texts = edited.select("*", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    prints = fingerprinted(texts.withColumnsRenamed({"text": "fingerprint", "edited": "edited_fingerprint"}), ("fingerprint", "edited_fingerprint"), words, ("n_chars", "edited_sha256"))
    prints = stored(prints, "fingerprints")
    first = prints.groupBy("doc_id").agg(F.min("fingerprint").alias("next_fingerprint")) if not alone else prints.select("doc_id", F.col("fingerprint").alias("next_fingerprint"))
    out = prints.join(nexts, "doc_id", "left").join(first.withColumnRenamed("doc_id", "next_id"), "next_id", "left")
    if not alone:
        copies = docs.groupBy(F.col("doc_id").alias("_i"), F.xxhash64("text").alias("_k")).agg(F.count("*").cast("int").alias("_n"))
        out = out.join(copies, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("key") == F.col("_k"))).withColumn("_c", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", alike(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), alike(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
