"""Mixing sources to target weights by min-cost flow, then by seeded selection of documents.

Documents are aggregated by membership pattern (the set of sources that hold them). Tokens flow
from patterns to the sources' quotas; using a pattern's tokens again costs more each time, so the
flow repeats as little as it can. Spark then takes documents in a seeded order until each flow is
full. The driver sees one row per pattern and per range of the order, never one per document.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import WORD, stored


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: Mapping[str | None, int], weights: Mapping[str | None, float], most: int = 3) -> dict[str | None, float]:
    """The whole size shared by weight; a target stops at most x its source's size, the excess is shared again."""
    whole, open_ = float(sum(sizes.values())), set(sizes)
    out = dict.fromkeys(sizes, 0.0)
    while open_:
        total = sum(weights[s] for s in sorted(open_, key=str))
        if total <= 0:
            break
        left = whole - sum(out[s] for s in sizes if s not in open_)
        over = {s for s in open_ if left * weights[s] / total > most * sizes[s]}
        for s in over:
            out[s] = float(most * sizes[s])
        if not over:
            out.update({s: left * weights[s] / total for s in open_})
            break
        open_ -= over
    return out


def min_cost_flow(supply: Sequence[int], member: Sequence[Sequence[int]], quota: Sequence[int], most: int) -> dict[tuple[int, int], int]:
    """Tokens from each pattern to each of its sources: as much of the quotas as can be met, at least cost.

    A pattern gives its tokens most times, the r-th time at cost r - 1 a token. Successive shortest
    paths with potentials; every path saturates an arc.
    """
    n, m = len(supply), len(quota)
    source, sink = n + m, n + m + 1
    arcs: list[list[int]] = []
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def arc(u: int, v: int, room: int, cost: int) -> None:
        for a, b, c, d in ((u, v, room, cost), (v, u, 0, -cost)):
            out[a].append(len(arcs))
            arcs.append([b, c, d])

    for p in range(n):
        for r in range(most):
            arc(source, p, supply[p], r)
    middle = len(arcs)
    for p in range(n):
        for s in member[p]:
            arc(p, n + s, most * supply[p], 0)
    last = len(arcs)
    for s in range(m):
        arc(n + s, sink, quota[s], 0)
    potential = [0] * (n + m + 2)
    while True:
        far = {source: 0}
        via: dict[int, int] = {}
        heap = [(0, source)]
        done = set()
        while heap:
            d, u = heapq.heappop(heap)
            if u in done:
                continue
            done.add(u)
            for e in out[u]:
                v, room, cost = arcs[e]
                new = d + cost + potential[u] - potential[v]
                if room and new < far.get(v, 1 << 60):
                    far[v], via[v] = new, e
                    heapq.heappush(heap, (new, v))
        if sink not in far:
            break
        longest = max(far.values())
        potential = [p + far.get(i, longest) for i, p in enumerate(potential)]
        path, at = [], sink
        while at != source:
            path.append(via[at])
            at = arcs[via[at] ^ 1][0]
        push = min(arcs[e][1] for e in path)
        for e in path:
            arcs[e][1] -= push
            arcs[e ^ 1][1] += push
    return {(arcs[e ^ 1][0], arcs[e][0] - n): arcs[e ^ 1][1] for e in range(middle, last, 2) if arcs[e ^ 1][1]}


def cycled(names: Sequence[str | None], weights: Sequence[float] = (5, 2, 1)) -> dict[str | None, float]:
    """Weights in turn to the sources by code point, a missing name last."""
    ordered = sorted((s for s in names if s is not None)) + [None] * (None in names)
    return {s: float(weights[i % len(weights)]) for i, s in enumerate(ordered)}


def _keyed(docs: DataFrame, sources: Column, seed: int) -> DataFrame:
    """docs with _p, the membership pattern as a string, and _h, their place (0 to 2**63) in the seeded order."""
    names = F.array_sort(F.array_distinct(F.when(F.size(sources) > 0, sources).otherwise(F.array(F.lit(None).cast("string")))))
    docs = docs.withColumn("_sources", names).withColumn("_p", F.to_json("_sources", {"ignoreNullFields": "false"}))
    return docs.withColumn("_h", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("_p")), 1))


def plan_mix(docs: DataFrame, sources: Column, weights: Sequence[float] | Mapping[str | None, float] = (5, 2, 1), most: int = 3, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The sized documents (doc_id, _p, _h, size), and the plan: a row for each membership pattern.

    The plan says how often all of a pattern's documents are taken (full) and up to which place in
    the seeded order they are taken once more (cut). It is broadcast: the driver holds it anyway.
    """
    base = _keyed(docs.select("doc_id", "text", sources.alias("_s")), F.col("_s"), seed)
    base = stored(base.select("doc_id", "_sources", "_p", "_h", words_in(F.col("text")).alias("size")), "sizes")
    rows = base.groupBy("_p").agg(F.first("_sources").alias("sources"), F.sum("size").alias("size")).collect()
    patterns = sorted(((r["_p"], tuple(r["sources"]), r["size"]) for r in rows), key=lambda x: [(s is None, s or "") for s in x[1]])
    every = sorted({s for _, p, _ in patterns for s in p}, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(n for _, p, n in patterns if s in p) for s in every}
    target = targets(sizes, weights if isinstance(weights, Mapping) else cycled(every, weights), most)
    place = {s: i for i, s in enumerate(every)}
    flow = min_cost_flow([n for *_, n in patterns], [[place[s] for s in p] for _, p, _ in patterns], [round(target[s]) for s in every], most)
    given = []
    for k, (p, names, n) in enumerate(patterns):
        give = sum(f for (i, _), f in flow.items() if i == k)
        full = min(most, give // n) if n else 0
        given.append((p, full, give - full * n, sizes[names[0]], target[names[0]]))
    schema = "_p string, full int, rest long, source_size long, target double"
    plan = F.broadcast(docs.sparkSession.createDataFrame(given, schema))
    # The cut lies in one range of the order; only that range's documents are sorted.
    part = F.shiftrightunsigned("_h", 51)
    ranges = base.groupBy("_p", part.alias("_range")).agg(F.sum("size").alias("held"))
    upto = Window.partitionBy("_p").orderBy("_range")
    ranges = ranges.withColumn("upto", F.sum("held").over(upto)).join(plan, "_p").where("rest > 0 AND upto >= rest")
    hit = ranges.groupBy("_p", "rest").agg(F.min_by(F.struct("_range", (F.col("upto") - F.col("held")).alias("before")), "_range").alias("x")).select("_p", "rest", F.col("x._range").alias("_range"), F.col("x.before").alias("before"))
    near = base.withColumn("_range", part).join(F.broadcast(hit), ["_p", "_range"])
    inside = Window.partitionBy("_p").orderBy("_h")
    # A document over the cut is taken if more than half of it lies before the cut.
    near = near.withColumn("to", F.col("before") + F.sum("size").over(inside)).withColumn("taken", F.col("to") - F.col("size") / 2 < F.col("rest"))
    cuts = {r["_p"]: r["cut"] for r in near.groupBy("_p").agg(F.coalesce(F.max(F.when(F.col("taken"), F.col("_h"))), F.min("_h") - 1).alias("cut")).collect()}
    plan = docs.sparkSession.createDataFrame([(*g, cuts.get(g[0], -1)) for g in given], schema + ", cut long")
    return base, F.broadcast(plan)


def mix_sources(docs: DataFrame, sources: Column, weights: Sequence[float] | Mapping[str | None, float] = (5, 2, 1), most: int = 3, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size and target (of a document's first source) and copies of every document.

    docs has doc_id and text; sources is an array of the names of the sources that hold a document
    (a null or empty array is the nameless source; a null name is that source too). size counts
    words; a null text has none. copies (0 to most) says how often the mix takes a document; a
    source's taken words differ from its target by about one document for each pattern that serves
    it, unless its patterns' most-fold size doesn't reach the target. Documents are taken in the
    order of a seeded hash of doc_id and sources, so reruns agree; rows equal in these are taken
    together. An empty table gives no rows. If every size is 0, nothing is taken.
    """
    base, plan = plan_mix(docs, sources, weights, most, seed)
    return base.join(plan, "_p").select("doc_id", "size", "source_size", "target", _copies().alias("copies"))


def _copies() -> Column:
    return F.col("full") + (F.col("_h") <= F.col("cut")).cast("int")


def mixed(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = 3, seed: int = 17) -> DataFrame:
    """The mix itself: every row of docs (doc_id, text, source and others) as often as it is taken.

    Texts are not shuffled: each row finds its own decision in the broadcast plan.
    """
    _, plan = plan_mix(docs, F.array("source"), weights, most, seed)
    # The caller's columns travel as one, whatever their names.
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), "doc_id", F.array("source").alias("_s"))
    rows = _keyed(rows, F.col("_s"), seed).join(plan, "_p").withColumn("_copies", _copies()).where("_copies > 0")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
