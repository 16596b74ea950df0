"""Best-fit packing: tokenized documents, cut into pieces, into sequences of a fixed length.

A bounded-space online best-fit: a fixed number of bins are open; a bitset keyed by free space
finds the fullest bin that a piece fits; if none does and no more may be open, the fullest closes.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import stored, text_slices

LENGTH = 2048
OPEN_BINS = 1024
#: Words whose ids a task remembers.
MEMORY = 300_000
#: Pieces that one task packs, on average.
PIECES_PER_TASK = 150_000

_ODD = re.compile(r" \s|\s\s|\x01")


class Encoder:
    """Token ids of a byte-level BPE, with a memory of words.

    The pattern of the vocabulary never joins a word to the space after it, nor a line break to its
    neighbours, if no white space stands beside other white space; so such a text's ids are those
    of its words one after the other. Other texts are encoded whole.
    """

    def __init__(self, path: str, memory: int = MEMORY) -> None:
        import public_tokenizers
        import tiktoken

        with open(re.sub(r"\.json$", ".tiktoken", path), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.memory = memory
        self.known: dict[str, bytes] = {}
        with open(path, "rb") as file:
            added = json.load(file).get("added_tokens") or []
        if odd := [t["content"] for t in added if t["single_word"] or t["lstrip"] or t["rstrip"]]:
            raise ValueError(f"added tokens that look at their neighbours: {odd}")
        self.added = {t["content"]: np.asarray([t["id"]], "<u4").tobytes() for t in added}
        # The first in the text, and of those the longest.
        self._added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.encode(text), "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        # \x01 in front: no space before the word.
        ids = self._whole(word[1:] if word[:1] == "\x01" else word if word == "\n" else " " + word)
        if len(self.known) < self.memory and len(word) < 40:
            self.known[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text without added tokens; one that stands in it is read as plain text."""
        if not text:
            return b""
        if _ODD.search(text) or text[0] in " \n" or text[-1] == " ":
            return self._whole(text)
        words = ("\x01" + text.replace("\n", " \n \x01")).split(" ")
        if words[-1] == "\x01":
            words.pop()
        found = list(map(self.known.get, words))
        if None in found:
            found = [ids if ids is not None else self._word(word) for ids, word in zip(found, words, strict=True)]
        return b"".join(found)

    def whole_ids(self, text: str) -> bytes:
        """The ids that the tokenizer as loaded gives: an added token in the text is its id, and what stands between is encoded by itself."""
        if not self._added or not self._added.search(text):
            return self.ids(text)
        return b"".join(self.added[part] if k % 2 else self.ids(part) for k, part in enumerate(self._added.split(text)))


def tokenized(docs: DataFrame, path: str, length: int = LENGTH, end: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32[, ids]) of every document, each of at most length tokens.

    A document is its ids and then the id end; a null text is empty and so has that id alone. Only
    longer ones are cut, the first piece takes what is over a multiple of length. Rows with the same
    or no doc_id are documents of their own. A text is held whole, with its ids. An added token of
    the vocabulary that stands in a text is one id, as the tokenizer itself reads it.
    """
    ids_field = [("ids", pa.list_(pa.int32()))] if with_ids else []
    tail = np.asarray([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch, texts in text_slices(batches):
            encoder = encoder or Encoder(path)
            out: list[tuple] = []
            for doc, raw in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = encoder.whole_ids(raw.decode("utf-8", "replace")) + tail
                n = len(ids) // 4
                at, piece = 0, 0
                while at < n:
                    to = at + ((n - at) % length or length) if not at else at + length
                    part = ids[4 * at : 4 * to]
                    out.append((doc, piece, at, to - at, zlib.crc32(part), *([np.frombuffer(part, "<i4")] if with_ids else [])))
                    at, piece = to, piece + 1
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *(k for _, k in ids_field)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", *(n for n, _ in ids_field)])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)


_KEYS = ["doc_id", "piece", "start", "length", "ids_crc32"]


class Bins:
    """Open bins by free space. place() gives a piece's bin and offset."""

    def __init__(self, length: int, most: int) -> None:
        self.length, self.most = length, most
        self.bits, self.count, self.made = 0, 0, 0
        self.at: list[list[int]] = [[] for _ in range(length + 1)]

    def _take(self, free: int) -> int:
        bins = self.at[free]
        one = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.count -= 1
        return one

    def place(self, size: int) -> tuple[int, int]:
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            one = self._take(free)
        else:
            if self.count == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, one = self.length, self.made
            self.made += 1
        if free > size:  # a full bin is closed
            self.at[free - size].append(one)
            self.bits |= 1 << (free - size)
            self.count += 1
        return one, self.length - free


def packed(pieces: DataFrame, tasks: int, length: int = LENGTH, open_bins: int = OPEN_BINS) -> DataFrame:
    """pieces with sequence_id and offset: where each is, sequences are gapless from 0.

    Each task packs its share online, in an order fixed by doc_id, piece and content, so that a
    repeated task packs the same. Equal pieces are interchangeable. A sequence belongs to one task.
    """
    share = pieces.withColumn("_share", F.pmod(F.xxhash64(*_KEYS), F.lit(tasks)))
    spread = share.repartition(tasks, "_share").sortWithinPartitions("_share", F.xxhash64(F.lit(1), *_KEYS), *_KEYS)
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, bins = None, Bins(length, open_bins)
        for batch in batches:
            ids, offsets = [], []
            for s, n in zip(batch.column("_share").to_pylist(), batch.column("length").to_pylist(), strict=True):
                if s != share:
                    share, bins = s, Bins(length, open_bins)
                one, at = bins.place(n)
                ids.append((s << 40) | one)
                offsets.append(at)
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.int64()), pa.array(offsets, pa.int64())], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return spread.mapInArrow(place, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH, open_bins: int = OPEN_BINS, with_ids: bool = False) -> DataFrame:
    """All documents tokenized and packed; see tokenized() and packed().

    The number of tasks follows the number of pieces, so that sequences left half empty at the end
    of a task stay a fixed small share: a table of fewer than PIECES_PER_TASK is packed in one task,
    as more of them would need more sequences. Only the pieces' names and lengths go there; with_ids
    joins their ids to their places afterwards. An empty table gives no rows.
    """
    pieces = stored(tokenized(docs, path, length, with_ids=with_ids), "pieces")
    tasks = max(1, round(pieces.count() / PIECES_PER_TASK))
    places = packed(pieces.drop("ids"), tasks, length, open_bins)
    if not with_ids:
        return places
    # Equal pieces are told apart by their number; which one gets which place doesn't matter. One shuffle serves both steps.
    key = F.xxhash64(*_KEYS).alias("key")
    placed = places.select(key, *_KEYS, "sequence_id", "offset", F.lit(None).cast("array<int>").alias("ids"))
    held = pieces.select(key, *_KEYS, F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset"), "ids")
    both = placed.unionByName(held).repartition("key").withColumn("side", F.col("ids").isNull())
    both = both.withColumn("nth", F.row_number().over(Window.partitionBy("key", "side").orderBy(*_KEYS)))
    met = both.groupBy("key", "nth").agg(F.max(F.struct(*_KEYS)).alias("piece"), *[F.max(c).alias(c) for c in ("sequence_id", "offset", "ids")])
    return met.select("piece.*", "sequence_id", "offset", "ids")
