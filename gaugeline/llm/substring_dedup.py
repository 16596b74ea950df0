"""Substring dedup: Rabin-Karp hashes of all windows of a fixed number of words.

Every window's hash goes to one of many shares of the hash space, packed by document. A share sorts its
hashes, keeps each one's first window (smallest doc_id, then earliest start) and tells the
documents of the others which of their windows repeat; those merge into maximal removal intervals.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import documents, mix, pack, partitions, spans, stored, text_slices, unpack, word_hashes

WINDOW = 20
#: Text per share of the hash space: a task sorts a share's windows, about 1 for 6 bytes, at once.
SHARE_BYTES = 12 << 20
LEAST_SHARES = 12
#: Text whose words are hashed at once, and whose windows are packed together.
CHUNK = 2 << 20
BLOCK_BYTES = 6 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LAST = np.iinfo(np.int64).max


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def window_hashes(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rabin-Karp hash, document (index) and start of each window, and a tag of each document's words."""
    n = len(hashes)
    begin, _ = spans(counts)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * _powers(_BASE, n), dtype=np.uint64, out=sums[1:])
    back = _powers(_BASE_INVERSE, n + 1)
    tag = (mix((sums[begin + counts] - sums[begin]) * back[begin]) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    windows = np.maximum(counts - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), windows)
    start = np.arange(len(doc)) - np.repeat(spans(windows)[0], windows)
    at = begin[doc] + start
    return mix((sums[at + size] - sums[at]) * back[at]), doc, start, tag


_SENT = "share int, bucket int, hashes binary, runs binary, places binary"
_REPLY = "bucket int, runs binary, places binary"
_RUN = np.dtype([("doc_id", "<i8"), ("tag", "<u4"), ("count", "<u4")])


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _runs(ids: np.ndarray, tags: np.ndarray, starts: np.ndarray) -> tuple[bytes, bytes]:
    """Windows in runs of the same document, and the gaps between their starts: both compress well."""
    edge = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])])
    run = np.zeros(len(edge), _RUN)
    run["doc_id"], run["tag"], run["count"] = ids[edge], tags[edge], np.diff(np.r_[edge, len(ids)])
    return pack(run), pack(np.diff(starts, prepend=0).astype(np.int32))


def _by(key: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each key below most that occurs, and where, in order."""
    order = np.argsort(key.astype(np.uint32), kind="stable")
    begin = np.searchsorted(key[order], np.arange(most + 1))
    for k in np.flatnonzero(begin[1:] > begin[:-1]):
        yield int(k), order[begin[k] : begin[k + 1]]


def _replies(ids: np.ndarray, tags: np.ndarray, starts: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Repeated windows, packed by the bucket of their document. The arrays are sorted by document."""
    for bucket, at in _by(ids % buckets, buckets):
        yield bucket, *_runs(ids[at], tags[at], starts[at])


def repeated_windows(docs: DataFrame, buckets: int, size: int = WINDOW, share_bytes: int = SHARE_BYTES) -> DataFrame:
    """(bucket, runs, places): each document's windows whose words also start a window earlier, packed by doc_id modulo buckets.

    A run is a document's doc_id, a tag that tells rows of the same doc_id but other words apart,
    and its number of places. Within a block of text only a hash's first window is sent on, so a
    passage that a third of all documents share reaches its share once per block.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shares = max(LEAST_SHARES, math.ceil(total / share_bytes))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        weight = 0

        def flush() -> pa.RecordBatch:
            ids, tags, starts, hashes = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            # The first window of each hash in this block, by doc_id and start.
            if (np.diff(ids) < 0).any():
                order = np.lexsort((starts, tags, ids))
                ids, tags, starts, hashes = ids[order], tags[order], starts[order], hashes[order]
            order = np.argsort(hashes, kind="stable")
            again = np.zeros(len(ids), bool)
            again[order] = ~_firsts(hashes[order], ids[order], starts[order])
            # These replies are known already; the shares only pass them on.
            rows = [(bucket % shares, bucket, None, *x) for bucket, *x in _replies(ids[again], tags[again], starts[again], buckets)]
            ids, tags, starts, hashes = (x[~again] for x in (ids, tags, starts, hashes))
            for share, at in _by((hashes >> np.uint64(32)) % np.uint64(shares), shares):
                rows.append((share, None, hashes[at].tobytes(), *_runs(ids[at], tags[at], starts[at])))
            return _batch(rows, _SENT)

        for batch, texts in text_slices(batches, limit=CHUNK):
            words: list[bytes] = []
            counts = np.zeros(len(texts), np.int64)
            for k, text in enumerate(texts):
                found = text.split()
                counts[k] = len(found)
                words += found
            h, doc, start, tag = window_hashes(word_hashes(words), counts, size)
            ids = batch.column("doc_id").to_numpy()
            if len(h):
                held.append((ids[doc], tag[doc], start.astype(np.int32), h))
                weight += sum(map(len, texts))
            if weight >= BLOCK_BYTES:
                yield flush()
                weight = 0
        if held:
            yield flush()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def decide() -> pa.RecordBatch:
            hashes = np.concatenate([np.frombuffer(x[0], np.uint64) for x in held])
            order = np.argsort(hashes)
            ordered = hashes[order]
            # Only hashes with more than one window matter from here on.
            same = ordered[1:] == ordered[:-1]
            order = order[np.r_[same, False] | np.r_[False, same]]
            hashes = hashes[order]
            del ordered, same
            runs = [unpack(x[1], _RUN) for x in held]
            ids = np.concatenate([np.repeat(x["doc_id"], x["count"]) for x in runs])[order]
            tags = np.concatenate([np.repeat(x["tag"], x["count"]) for x in runs])[order]
            # A document's first gap leads back to its own start, so the sums run over a whole row.
            starts = np.concatenate([np.cumsum(unpack(x[2], np.int32), dtype=np.int32) for x in held])[order]
            held.clear()
            order = np.lexsort((starts, ids, hashes))
            again = order[~_firsts(hashes[order], ids[order], starts[order])]
            again = again[np.lexsort((starts[again], tags[again], ids[again]))]
            return _batch(list(_replies(ids[again], tags[again], starts[again], buckets)), _REPLY)

        for batch in batches:
            for share, bucket, hashes, runs, places in zip(*(batch.column(c) for c in ("share", "bucket", "hashes", "runs", "places")), strict=True):
                share, bucket = share.as_py(), bucket.as_py()
                if bucket is not None:
                    yield _batch([(bucket, runs.as_py(), places.as_py())], _REPLY)
                    continue
                if share != now and held:
                    yield decide()
                now = share
                held.append((hashes.as_py(), runs.as_py(), places.as_py()))
        if held:
            yield decide()

    sent = docs.select("doc_id", "text").mapInArrow(send, _SENT).repartition(shares, "share").sortWithinPartitions("share")
    return sent.mapInArrow(judge, _REPLY)


def _firsts(hashes: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of windows sorted by hash, doc_id and start: whether none of the same hash starts earlier."""
    if not len(hashes):
        return np.zeros(0, bool)
    edge = np.r_[True, hashes[1:] != hashes[:-1]]
    head = np.flatnonzero(edge)[np.cumsum(edge) - 1]
    return (ids == ids[head]) & (starts == starts[head])


def remove_repeats(docs: DataFrame, size: int = WINDOW, keep_text: bool = True, share_bytes: int = SHARE_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document, and with keep_text its text: the kept words, one space between.

    A word goes if a window of size words covers it whose words also start a window earlier: in a
    document of a smaller doc_id, or before it in the same document. Texts with fewer words keep
    all; null and empty texts have no words. Rows with the same doc_id are one document whose rows
    all start at 0, so equal rows lose the same words; rows without doc_id come last and are one
    document too. Windows are compared by a 64-bit hash. Other columns are left out; see
    deduplicated() for whole rows.
    """
    rows = documents(docs, "doc_id", "text")
    return _removed(rows, size, keep_text, share_bytes, []).drop(*([] if keep_text else ["text"]))


def deduplicated(docs: DataFrame, size: int = WINDOW, share_bytes: int = SHARE_BYTES) -> DataFrame:
    """The rows of docs with the words kept as text; texts that lose nothing stay as they are. n_chars follows the text."""
    # The other columns travel as one, whatever their names.
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    rows = documents(docs.withColumn("_row", F.struct(*others, F.lit(0).alias("_"))), "doc_id", "text", "_row")
    out = _removed(rows, size, True, share_bytes, ["_row"])
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[(own.get(c) if c in own else F.col("_row").getField(c)).alias(c) for c in docs.columns])


def _removed(rows: DataFrame, size: int, keep_text: bool, share_bytes: int, others: list[str]) -> DataFrame:
    """Documents and replies meet by bucket; in each bucket the replies come first."""
    buckets = _prime(max(LEAST_SHARES, partitions(rows.sparkSession)))
    rows = rows.withColumn("_null", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(int(_LAST))))
    found = stored(repeated_windows(rows, buckets, size, share_bytes), "windows")
    given = rows.withColumn("bucket", F.pmod("doc_id", F.lit(buckets)).cast("int"))
    both = given.unionByName(found, allowMissingColumns=True).repartition(buckets, "bucket")
    both = both.sortWithinPartitions("bucket", F.col("runs").isNull())
    kinds = [rows.schema[c] for c in others]
    schema = "doc_id long, text string, n_words long, n_removed long, kept_sha256 string" + "".join(f", `{k.name}` {k.dataType.simpleString()}" for k in kinds)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known = None, {}
        for batch, texts in text_slices(batches, limit=CHUNK):
            out: list[tuple] = []
            columns = (batch.column(c) for c in ("bucket", "doc_id", "_null", "runs", "places"))
            for text, bucket, doc, null, runs, places in zip(texts, *columns, strict=True):
                if bucket.as_py() != now:
                    now, known = bucket.as_py(), {}
                if runs.is_valid:
                    all_runs = unpack(runs.as_py(), _RUN)
                    starts = np.cumsum(unpack(places.as_py(), np.int32), dtype=np.int32)
                    for one, a, b in zip(all_runs.tolist(), *(x.tolist() for x in spans(all_runs["count"])), strict=True):
                        known.setdefault(one[0], []).append((one[1], starts[a:b]))
                    continue
                words = text.split()
                kept = words
                if doc.as_py() in known:
                    tag = window_hashes(word_hashes(words), np.asarray([len(words)]), size)[3][0]
                    gone = np.zeros(len(words) + 1, np.int64)
                    for t, starts in known[doc.as_py()]:
                        if t == tag:
                            np.add.at(gone, starts, 1)
                            np.add.at(gone, starts + size, -1)
                    stay = np.cumsum(gone)[:-1] == 0
                    kept = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                joined = b" ".join(kept)
                new = None if not keep_text else joined if len(kept) < len(words) else text
                out.append((None if null.as_py() else doc.as_py(), new, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest()))
            docs, new, n, removed, digest = zip(*out, strict=True) if out else [()] * 5
            text = pa.array(new, pa.binary()).cast(pa.string())
            real = batch.filter(batch.column("runs").is_null())
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), text, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), *(real.column(c) for c in others)], names=["doc_id", "text", "n_words", "n_removed", "kept_sha256", *others])

    return both.mapInArrow(cut, schema)


def _prime(n: int) -> int:
    while any(n % k == 0 for k in range(2, math.isqrt(n) + 1)):
        n += 1
    return n
