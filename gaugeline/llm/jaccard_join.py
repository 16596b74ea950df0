"""N-gram Jaccard join: a size-aware heavy-light join over the sets of word shingles.

Two sets with Jaccard similarity t share at least t of either, hence SUBSET elements of both sets'
rarest (1 - t) and a few. Small sets are joined by enumerating those elements' subsets of fixed
size; large sets by scanning inverted lists of single elements and counting; the boundary between
them is where the estimated work is least.

Equal sets are one node from the start. In a first pass each list links its members to its
smallest one only, and the components of the verified links are found; the second pass compares
what is left: pairs of one list that lie in different components. So a group of copies costs its
size, not its square, and no link between components is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import components, documents, mix, pack, partitions, spans, stored, text_slices, unpack, word_hashes

SHINGLE = 5
#: Similarity as a fraction.
SIMILAR = (3, 4)
#: Elements of an enumerated subset, and shared elements that make two large sets candidates.
SUBSET = 2
#: log2 of the buckets of the frequency sketch, of a byte each: it is broadcast.
SKETCH_BITS = 22
BLOCK_BITS = 16
#: Sets of more elements are never enumerated.
LARGEST_SMALL = 64
#: Set elements per share of the lists, on average.
SHARE_ELEMENTS = 3_000_000
#: Members of one star that one task compares.
STAR = 512
#: Pairs that a task holds before it passes them on.
PAIRS_HELD = 2_000_000
#: Blocks of nodes, at least; pairs of blocks are compared in one place.
LEAST_BLOCKS = 6
#: Bytes of sets in a block, about.
BLOCK_BYTES = 48 << 20

_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_NO_ID = np.iinfo(np.int64).max


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, its A-Z in lower case; a shorter text is one shingle."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        found = text.lower().split()
        counts[k] = len(found)
        words += found
    hashes = word_hashes(words)
    begin, ends = spans(counts)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    power = np.cumprod(np.full(len(hashes) + 1, _BASE, np.uint64), dtype=np.uint64)
    np.cumsum(hashes * power[: len(hashes)], dtype=np.uint64, out=sums[1:])
    back = np.cumprod(np.full(len(hashes) + 1, _BASE_INVERSE, np.uint64), dtype=np.uint64)
    wide = mix((sums[size:] - sums[:-size]) * back[: len(sums) - size]) if len(sums) > size else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(begin.tolist(), ends.tolist(), strict=True):
        if b - a >= size:
            one = np.sort(wide[a : b - size + 1])
            out.append(one[np.r_[True, one[1:] != one[:-1]]])
        elif b > a:
            out.append(mix((sums[b : b + 1] - sums[a]) * back[a] + np.uint64(b - a)))
        else:
            out.append(hashes[:0])
    return out


def node_of(one: np.ndarray) -> int:
    """A 64-bit digest of a set."""
    total = np.add.reduce(mix(one ^ np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)
    return int(mix(np.asarray([total], np.uint64) + np.uint64(len(one)))[0].view(np.int64))


def least_shared(n: int, similar: tuple[int, int] = SIMILAR) -> int:
    """Elements that a set of n shares at least with any similar set."""
    return -(-similar[0] * n // similar[1])


def prefix_length(n: int, similar: tuple[int, int] = SIMILAR) -> int:
    return min(n, n - least_shared(n, similar) + SUBSET)


def boundary(sizes: dict[int, int], list_length: float, similar: tuple[int, int] = SIMILAR) -> int:
    """The largest size that is joined by subsets: where the sum of both kinds' work is least."""
    def work(b: int) -> float:
        out = 0.0
        for n, many in sizes.items():
            p = prefix_length(n, similar)
            if n <= b:
                out += many * math.comb(p, SUBSET)
            if n >= least_shared(b + 1, similar):
                out += many * p * (1 + list_length)
        return out

    return min(range(LARGEST_SMALL + 1), key=lambda b: (work(b), b))


# --- sets, nodes and the frequency sketch


def _scan(docs: DataFrame) -> DataFrame:
    """A row for each document (doc_id, n, node), and each task's frequency sketch in blocks."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        names = ["doc_id", "n", "node", "block", "counts"]
        some = False
        for batch, texts in text_slices(batches):
            sets = shingle_sets(texts)
            some = True
            every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            sketch += np.bincount((every >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch)).astype(np.uint32)
            rows = len(sets)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) for s in sets], pa.int64()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names=names)
        if some:
            blocks = sketch.reshape(-1, 1 << BLOCK_BITS)
            n = len(blocks)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([pack(b) for b in blocks], pa.binary())], names=names)

    return docs.mapInArrow(scan, "doc_id long, n long, node long, block int, counts binary")


def _levels(blocks: DataFrame) -> tuple[np.ndarray, float]:
    """The sketch of all tasks as levels of a byte, and the mean length of an element's list.

    The driver gets 2**SKETCH_BITS counts, however large the input."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[block] = sums.get(block, 0) + unpack(counts, np.uint32).astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([pack(x) for x in sums.values()], pa.binary())], names=["block", "counts"])

    summed = blocks.select("block", "counts").repartition(1 << (SKETCH_BITS - BLOCK_BITS), "block").mapInArrow(total, "block int, counts binary")
    counts = np.zeros((1 << (SKETCH_BITS - BLOCK_BITS), 1 << BLOCK_BITS), np.int64)
    for r in summed.collect():
        counts[r["block"]] = unpack(bytes(r["counts"]), np.int64)
    counts = counts.ravel()
    mean = max(1.0, counts.mean())
    levels = np.clip(np.rint(2 * np.log2(np.maximum(counts, 1) / mean)), 0, 255).astype(np.uint8)
    whole = counts.sum()
    return levels, float((counts.astype(float) ** 2).sum() / whole / mean) if whole else 0.0


# --- lists


def _lists(docs: DataFrame, levels: np.ndarray, small: int, shares: int, similar: tuple[int, int]) -> DataFrame:
    """(list, node) of all lists with several nodes: list is a hash of an element, or of a subset."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(levels)
    reach = least_shared(small + 1, similar)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        shift = np.uint64(64 - SKETCH_BITS)
        for _, texts in text_slices(batches, limit=12 << 20):
            keys, nodes, seen = [], [], set()
            for at in range(0, len(texts), 512):
                for one in shingle_sets(texts[at : at + 512]):
                    n = len(one)
                    if n < SUBSET + 1:  # only equal sets are similar
                        continue
                    node = node_of(one)
                    if node in seen:
                        continue
                    seen.add(node)
                    first = one[np.argsort(levels[(one >> shift).astype(np.int64)], kind="stable")[: prefix_length(n, similar)]]
                    if n <= small:
                        a, b = np.triu_indices(len(first), 1)
                        keys.append(mix(first[a] * np.uint64(3) + mix(first[b])))
                        nodes.append(np.full(len(a), node, np.int64))
                    if n >= reach:
                        keys.append(mix(first))
                        nodes.append(np.full(len(first), node, np.int64))
            if not keys:
                continue
            key, node = np.concatenate(keys), np.concatenate(nodes)
            share = (key % np.uint64(shares)).astype(np.uint32)
            order = np.argsort(share, kind="stable")
            key, node, share = (key[order] >> np.uint64(32)).astype(np.uint32), node[order], share[order]
            edge = np.flatnonzero(np.r_[True, share[1:] != share[:-1]])
            cut = list(zip(edge, np.r_[edge[1:], len(key)], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(share[edge].astype(np.int32)), pa.array([key[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([node[a:b].tobytes() for a, b in cut], pa.binary())], names=["share", "keys", "nodes"])

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def lists() -> pa.RecordBatch:
            key = np.concatenate([np.frombuffer(k, np.uint32) for k, _ in held])
            node = np.concatenate([np.frombuffer(n, np.int64) for _, n in held])
            held.clear()
            order = np.argsort(key, kind="stable")
            key, node = key[order], node[order]
            same = key[1:] == key[:-1]
            many = np.r_[same, False] | np.r_[False, same]
            key, node = key[many], node[many]
            order = np.lexsort((node, key))
            key, node = key[order], node[order]
            new = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])] if len(key) else np.zeros(0, bool)
            key, node = key[new], node[new]
            same = key[1:] == key[:-1]
            many = np.r_[same, False] | np.r_[False, same] if len(key) else np.zeros(0, bool)
            return pa.RecordBatch.from_arrays([pa.array((np.int64(now) << np.int64(32)) | key[many].astype(np.int64)), pa.array(node[many])], names=["list", "node"])

        for batch in batches:
            for share, keys, nodes in zip(*(batch.column(c).to_pylist() for c in ("share", "keys", "nodes")), strict=True):
                if share != now and held:
                    yield lists()
                now = share
                held.append((keys, nodes))
        if held:
            yield lists()

    sent = docs.select("text").mapInArrow(send, "share int, keys binary, nodes binary").repartition(shares, "share").sortWithinPartitions("share")
    return sent.mapInArrow(group, "list long, node long")


# --- verification


def similar_enough(shared: int, a: int, b: int, similar: tuple[int, int] = SIMILAR) -> bool:
    return similar[1] * shared >= similar[0] * (a + b - shared)


def _stars(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The links (a, b) among pairs (a, b) of few a with many b: each b's set is sent to its a."""
    many = pairs.groupBy("a").agg(F.count("*").alias("members")).withColumn("parts", F.ceil(F.col("members") / STAR).cast("int"))
    heads = many.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("member"), F.col("a").alias("b"))
    members = pairs.join(many.select("a", "parts"), "a").select("a", F.pmod(F.hash("b"), F.col("parts")).alias("part"), F.lit(True).alias("member"), "b")
    # Sets are joined alike at every size, by sorting: their requests grow with them.
    rows = heads.unionByName(members).join(sets.withColumnRenamed("id", "b").hint("merge"), "b")
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", "member")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.zeros(0, np.uint64)
        for batch, texts in text_slices(batches):
            a, member, b = (batch.column(c).to_pylist() for c in ("a", "member", "b"))
            found = []
            for i, one in enumerate(shingle_sets(texts)):
                if not member[i]:
                    head = one
                    continue
                at = np.searchsorted(head, one)
                at[at == len(head)] = 0
                if similar_enough(int((head[at] == one).sum()), len(head), len(one), similar):
                    found.append((a[i], b[i]))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["a", "b"])

    return rows.mapInArrow(compare, "a long, b long")


def _blocks(ids: np.ndarray, blocks: int) -> np.ndarray:
    return (mix(ids.view(np.uint64)) % np.uint64(blocks)).astype(np.int64)


_CELL = "cell long, pairs binary, counts binary"


def _cells(a: np.ndarray, b: np.ndarray, counts: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    """Sorted distinct pairs of each cell, a cell being a pair of blocks: gaps of ids compress well."""
    if not len(a):
        return
    x, y = _blocks(a, blocks), _blocks(b, blocks)
    swap = x > y
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    cell = np.minimum(x, y) * blocks + np.maximum(x, y)
    order = np.lexsort((b, a, cell))
    a, b, cell, counts = a[order], b[order], cell[order], counts[order]
    edge = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(a) else np.zeros(0, np.int64)
    rows = [(int(cell[s]), pack(np.stack([np.diff(a[s:e], prepend=0), np.diff(b[s:e], prepend=0)])), pack(counts[s:e].astype(np.uint16))) for s, e in zip(edge, np.r_[edge[1:], len(a)], strict=True)]
    if rows:
        c, p, k = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(p, pa.binary()), pa.array(k, pa.binary())], names=["cell", "pairs", "counts"])


def _pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    gaps = unpack(blob, np.int64).reshape(2, -1)
    return np.cumsum(gaps[0]), np.cumsum(gaps[1])


def _summed(a: np.ndarray, b: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs and their summed counts."""
    order = np.lexsort((b, a))
    a, b, counts = a[order], b[order], counts[order]
    edge = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, np.int64)
    return a[edge], b[edge], np.add.reduceat(counts, edge) if len(a) else counts


def _crossing(lists: DataFrame, blocks: int, small: int, similar: tuple[int, int]) -> DataFrame:
    """Packed pairs of the same list but of different components, with the number of lists they share.

    lists: list, id, n, component. Pairs of sizes that can't be similar are left out; a pair of two
    small sets counts as found, since its list is a subset."""
    lists = lists.repartition("list").sortWithinPartitions("list", "n")

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        many = 0
        rest: tuple[np.ndarray, ...] | None = None

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal many
            many = 0
            if held:
                a, b, c = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                yield from _cells(*_summed(a, b, c), blocks)

        def pairs(ids: np.ndarray, n: np.ndarray, comp: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Pairs of each row with the later ones of its list, which ends at ends."""
            nonlocal many
            width = ends - np.arange(len(ids)) - 1
            at = 0
            while at < len(ids):
                to = at + max(1, int(np.searchsorted(np.cumsum(width[at:]), PAIRS_HELD)))
                i = np.repeat(np.arange(at, to), width[at:to])
                j = i + 1 + np.arange(len(i)) - np.repeat(spans(width[at:to])[0], width[at:to])
                keep = (comp[i] != comp[j]) & (n[i] * similar[1] >= n[j] * similar[0])
                i, j = i[keep], j[keep]
                held.append((np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j]), np.where(n[j] <= small, SUBSET, 1)))
                many += len(i)
                if many >= PAIRS_HELD:
                    yield from flush()
                at = to

        def ends_of(key: np.ndarray) -> np.ndarray:
            return np.searchsorted(key, key, side="right")

        for batch in batches:
            now = tuple(batch.column(c).to_numpy() for c in ("list", "id", "n", "component"))
            if not len(now[0]):
                continue
            key, ids, n, comp = now if rest is None else (np.concatenate([x, y]) for x, y in zip(rest, now, strict=True))
            # The batch's last list may go on in the next one.
            whole = int(np.searchsorted(key, key[-1]))
            yield from pairs(ids[:whole], n[:whole], comp[:whole], ends_of(key[:whole]))
            rest = tuple(x[whole:] for x in (key, ids, n, comp))
        if rest is not None:
            yield from pairs(*rest[1:], ends_of(rest[0]))
        yield from flush()

    return lists.mapInArrow(cross, _CELL)


def _candidates(crossing: DataFrame) -> DataFrame:
    """Each cell's pairs that share enough lists: (cell, id, pairs), id for the sets needed there, pairs packed."""
    rows = crossing.repartition("cell").sortWithinPartitions("cell")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0

        def total() -> tuple[np.ndarray, ...]:
            return _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))

        def out() -> pa.RecordBatch:
            a, b, counts = total()
            a, b = a[counts >= SUBSET], b[counts >= SUBSET]
            need = np.unique(np.concatenate([a, b]))
            packed = [pack(np.stack([np.diff(a, prepend=0), np.diff(b, prepend=0)]))] if len(a) else []
            k = len(need) + len(packed)
            return pa.RecordBatch.from_arrays([pa.array(np.full(k, now, np.int64)), pa.array([*need.tolist(), *[None] * len(packed)], pa.int64()), pa.array([None] * len(need) + packed, pa.binary())], names=["cell", "id", "pairs"])

        for batch in batches:
            for cell, blob, counts in zip(*(batch.column(c).to_pylist() for c in ("cell", "pairs", "counts")), strict=True):
                if cell != now and held:
                    yield out()
                    held, size = [], 0
                now = cell
                held.append((*_pairs(blob), unpack(counts, np.uint16).astype(np.int64)))
                size += len(held[-1][0])
                if size >= 2 * PAIRS_HELD:
                    held = [total()]
                    size = 0
        if held:
            yield out()

    return rows.mapInArrow(merge, "cell long, id long, pairs binary")


def _verified(candidates: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Links (a, b) that span what the candidates' similar pairs connect, cell by cell."""
    need = candidates.where("id IS NOT NULL").select("cell", "id").join(sets.hint("merge"), "id").select("cell", "id", "text", F.lit(None).cast("binary").alias("pairs"))
    pairs = candidates.where("id IS NULL").select("cell", "id", F.lit(None).cast("string").alias("text"), "pairs")
    rows = need.unionByName(pairs).repartition("cell").sortWithinPartitions("cell", F.col("id").asc_nulls_last())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets = None, {}

        def links(blob: bytes) -> pa.RecordBatch:
            a, b = _pairs(blob)
            ids = np.asarray(sorted(sets), np.int64)
            parts = [sets[i] for i in ids.tolist()]
            sizes = np.asarray([len(p) for p in parts], np.int64)
            code = np.unique(np.concatenate(parts), return_inverse=True)[1].astype(np.int32)
            begin, ends = spans(sizes)
            mark = np.zeros(int(code.max()) + 1, bool)
            root = list(range(len(ids)))

            def top(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            x, y = np.searchsorted(ids, a), np.searchsorted(ids, b)
            found = []
            edge = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
            for s, e in zip(edge, np.r_[edge[1:], len(x)], strict=True):
                i = int(x[s])
                own = code[begin[i] : ends[i]]
                mark[own] = True
                for at in range(s, e, 2048):
                    other = y[at : min(at + 2048, e)]
                    many = sizes[other]
                    lo = spans(many)[0]
                    pick = np.arange(many.sum()) + np.repeat(begin[other] - lo, many)
                    shared = np.add.reduceat(mark[code[pick]], lo, dtype=np.int64)
                    good = similar[1] * shared >= similar[0] * (len(own) + many - shared)
                    for j in other[good].tolist():
                        p, q = top(i), top(j)
                        if p != q:
                            root[max(p, q)] = min(p, q)
                            found.append((int(ids[i]), int(ids[j])))
                mark[own] = False
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.int64()), pa.array([q for _, q in found], pa.int64())], names=["a", "b"])

        for batch, texts in text_slices(batches):
            # Rows of pairs have no text: their sets are empty and not used.
            for cell, one, elements, blob in zip(*(batch.column(c).to_pylist() for c in ("cell", "id")), shingle_sets(texts), batch.column("pairs").to_pylist(), strict=True):
                if cell != now:
                    now, sets = cell, {}
                if one is not None:
                    sets[one] = elements
                else:
                    yield links(blob)

    return rows.mapInArrow(compare, "a long, b long")


# --- the join


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, n, text) of the wanted nodes (node, id, n, doc_id), from one document of each.

    The text is kept, not its set: it is stored and sent in a few bytes a word, where a set's
    64-bit hashes take 8 bytes a shingle and don't compress. Who compares sets makes them again."""
    found = docs.hint("merge").join(wanted.select(F.col("doc_id").alias("_d"), "node", "id", "n"), F.col("doc_id") == F.col("_d")).select("text", "node", "id", "n")

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            sets = shingle_sets(texts)
            mine = pa.array([node_of(s) == n for s, n in zip(sets, batch.column("node").to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), batch.column("text")], names=["id", "n", "text"]).filter(mine)

    return found.mapInArrow(elements, "id long, n long, text string")


def join_near(docs: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """doc_id, n_shingles (size of the shingle set) and component_id of every document.

    Two documents link when the Jaccard similarity of their shingle sets is similar (a fraction) or
    more; component_id is the smallest doc_id that links reach, the document's own included. Sets are
    held as 64-bit hashes. Null and empty texts have the empty set, link with nothing and are
    their own component. Equal rows link; rows of the same doc_id with different texts link only if
    those are similar. A null doc_id counts as larger than any: its component_id is null unless it
    reaches a document that has one. Other columns are left out; an empty table gives no rows.
    """
    return _near(docs, similar).select("doc_id", "n_shingles", "component_id")


def _near(docs: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """join_near(), with node, the digest of a document's set."""
    docs = documents(docs, "doc_id", "text").withColumn("doc_id", F.coalesce("doc_id", F.lit(int(_NO_ID))))
    scanned = stored(_scan(docs), "sets")
    heads = scanned.where("block IS NULL").select("doc_id", "n", "node")
    levels, list_length = _levels(scanned.where("block IS NOT NULL"))
    sizes = heads.where("n > 0").groupBy(F.least("n", F.lit(LARGEST_SMALL + 1)).alias("n")).agg(F.count("*").alias("many")).collect()
    small = boundary({r["n"]: r["many"] for r in sizes}, list_length, similar)
    elements = heads.agg(F.sum("n")).first()[0] or 0
    shares = max(partitions(docs.sparkSession), math.ceil(elements / SHARE_ELEMENTS))
    links = _links(docs, heads, levels, small, shares, similar)
    # Components over ids, then the smallest doc_id of each.
    nodes = _nodes(heads)
    found = nodes.join(components(links).withColumnRenamed("node", "id"), "id", "left").select("node", "doc_id", F.coalesce("component", "id").alias("component"))
    best = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    best = found.join(best, "component").select("node", "component_id")
    out = heads.join(best, "node", "left").select("doc_id", "node", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    real = lambda c: F.when(F.col(c) != int(_NO_ID), F.col(c)).alias(c)
    return out.select(real("doc_id"), "node", "n_shingles", real("component_id"))


def _nodes(heads: DataFrame) -> DataFrame:
    """(node, n, doc_id, id) of each set that isn't empty: its smallest doc_id, and an id of its own, mostly the same."""
    nodes = heads.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"))
    firsts = nodes.groupBy("doc_id").agg(F.min("node").alias("first"))
    own = (F.col("first") == F.col("node")) & (F.col("doc_id") != int(_NO_ID))
    return nodes.join(firsts, "doc_id").select("node", "n", "doc_id", F.when(own, F.col("doc_id")).otherwise(-F.shiftrightunsigned("node", 1) - 1).alias("id"))


def _links(docs: DataFrame, heads: DataFrame, levels: np.ndarray, small: int, shares: int, similar: tuple[int, int]) -> DataFrame:
    nodes = _nodes(heads)
    lists = _lists(docs, levels, small, shares, similar).join(nodes.select("node", "id", "n"), "node")
    # A member stays if the next smaller or larger one of its list may be similar by size.
    by = Window.partitionBy("list").orderBy("n", "id")
    near = (F.lag("n").over(by) * similar[1] >= F.col("n") * similar[0]) | (F.col("n") * similar[1] >= F.lead("n").over(by) * similar[0])
    lists = stored(lists.withColumn("near", near).where("near").select("list", "id", "n"), "lists")
    # Similar sets share a subset's list, or SUBSET lists of elements.
    several = lists.groupBy("id").agg(F.count("*").alias("lists"), F.min("n").alias("n")).where((F.col("lists") >= SUBSET) | (F.col("n") <= small)).select("id")
    lists = stored(lists.join(several, "id", "left_semi"), "lists")
    listed = stored(nodes.join(several, "id", "left_semi"), "nodes")
    sets = stored(_sets(docs, listed), "sets")
    first = lists.groupBy("list").agg(F.min(F.struct("id", "n")).alias("least"))
    fits = F.least("n", "least.n") * similar[1] >= F.greatest("n", "least.n") * similar[0]
    stars = lists.join(first, "list").where(F.col("id") != F.col("least.id")).where(fits)
    # What shares too few lists with its smallest member is left to the second pass.
    enough = F.when(F.least("n", "least.n") <= small, SUBSET).otherwise(1)
    stars = stars.groupBy(F.col("least.id").alias("a"), F.col("id").alias("b")).agg(F.sum(enough).alias("shared")).where(F.col("shared") >= SUBSET).select("a", "b")
    links = stored(_stars(stored(stars, "stars"), sets, similar), "links")
    joined = components(links).withColumnRenamed("node", "id")
    parts = lists.join(joined, "id", "left").select("list", "id", "n", F.coalesce("component", "id").alias("component"))
    whole = sets.agg(F.sum(F.col("n") * 8)).first()[0] or 0
    blocks = max(LEAST_BLOCKS, math.ceil(whole / BLOCK_BYTES))
    candidates = stored(_candidates(_crossing(parts, blocks, small, similar)), "candidates")
    more = _verified(candidates, sets, similar)
    return links.unionByName(stored(more, "links")).unionByName(joined.select(F.col("component").alias("a"), F.col("id").alias("b")))


def one_of_each(docs: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """The rows of docs of which one stays of each component: that of its smallest doc_id.

    Of rows equal in doc_id and text one stays. A row without doc_id stays, since nothing tells
    which it is. Rows are found again by doc_id, those of a doc_id with several sets by their set
    too; other columns don't matter, whatever their names.
    """
    found = stored(_near(docs, similar).where("doc_id IS NOT NULL").select("doc_id", "node", (F.col("doc_id") != F.col("component_id")).alias("gone")).distinct(), "copies")
    several = found.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.bool_or("gone").alias("gone")).where("gone")
    several = stored(several.select("doc_id", (F.col("low") < F.col("high")).alias("several")), "several")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = rows.join(several, "doc_id", "left")
    unlike = _unlike(marked.where("several"), found.where("gone").select("doc_id", "node"))
    kept = marked.where("several IS NULL").select("row", "doc_id", "text").unionByName(unlike)
    once = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(0))
    kept = kept.withColumn("place", F.when(F.col("doc_id").isNull(), 1).otherwise(F.row_number().over(once)))
    return kept.where("place = 1").select("row.*")


def _unlike(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows (row, doc_id, text) whose own set isn't among those that go."""
    kind = rows.schema["row"].dataType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            nodes = pa.array([node_of(s) for s in shingle_sets(texts)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), batch.column("text"), nodes], names=["row", "doc_id", "text", "node"])

    found = rows.select("row", "doc_id", "text").mapInArrow(digests, f"row {kind}, doc_id long, text string, node long")
    return found.join(gone, ["doc_id", "node"], "left_anti").select("row", "doc_id", "text")
