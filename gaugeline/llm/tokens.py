"""Words of many texts at once, as numpy arrays: nothing is done per word in Python."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import word_hashes

#: Bits of a filter: a fixed 4 MB, whatever is put in. What it lets through wrongly is joined away later.
FILTER_BITS = 1 << 25


@dataclass
class Words:
    """Words of texts that were joined by a line feed: which text, where, and which of the distinct ones."""

    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    ids: np.ndarray
    names: list[bytes]
    hashes: np.ndarray


def words_of(texts: list[bytes], blob: bytes, inside: np.ndarray) -> Words:
    """blob: the texts joined by a line feed, and perhaps translated byte by byte; inside: for each byte value whether words hold it (not for the line feed)."""
    raw = np.frombuffer(blob, np.uint8)
    of_word = inside[raw]
    edge = np.flatnonzero(np.diff(of_word, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    held = raw[of_word].tobytes()
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(held)])
    coded = array.dictionary_encode()
    names = coded.dictionary.to_pylist()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    text_ends = np.cumsum(lengths + 1)
    return Words(np.searchsorted(text_ends, starts, side="right"), starts, ends, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), names, word_hashes(names))


def filter_of(rows: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the hashes in a column: FILTER_BITS bits come to the driver, however many rows there are."""
    at = F.col(column).bitwiseAND(F.lit(FILTER_BITS - 1)) + 1
    parts = rows.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(FILTER_BITS >> 3, np.uint8)
    for r in parts.collect():  # at most FILTER_BITS / 32768 rows of 4 KB
        begin = (r["bucket"] - 1) * 4096
        out[begin : begin + 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(FILTER_BITS - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))
