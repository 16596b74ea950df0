"""Embedding near-dedup by counting collisions in query-centred windows of one-dimensional projections.

Every vector is projected on several random lines. Two vectors collide on a line when one lies in
the window around the other; near ones collide on nearly all lines. A pair that collides on at
least `count` of m lines collides on one of the first m - count + 1, so candidates are looked for
along those lines only, each sorted; they are counted on the rest and verified by cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import components, stored

COSINE = 0.93
#: Lines, half a window in standard deviations of a borderline pair's distance, and the recall of such pairs.
LINES, WIDTH, RECALL = 24, 2.4, 0.99
#: Vectors in a tile; a pair of tiles is compared in one place.
TILE = 1024
#: Vectors of a tile that are compared with their windows at once.
STRIPE = 64


@dataclass(frozen=True)
class Plan:
    lines: int
    half: float
    count: int

    @property
    def sorted_lines(self) -> int:
        return self.lines - self.count + 1


def calibrated(cosine: float = COSINE, lines: int = LINES, width: float = WIDTH, recall: float = RECALL) -> Plan:
    """The largest count of collisions that a pair at the threshold reaches with the wanted chance.

    The difference of two unit vectors' projections on a random line is normal; its deviation at the
    threshold is their distance. Closer pairs collide more often.
    """
    hit = math.erf(width / math.sqrt(2))
    at_least, count = 0.0, lines + 1
    while at_least < recall:
        count -= 1
        at_least += math.comb(lines, count) * hit**count * (1 - hit) ** (lines - count)
    return Plan(lines, width * math.sqrt(2 - 2 * cosine), count)


def _projected(rows: DataFrame, plan: Plan, seed: int) -> DataFrame:
    """(vec_id, label, vector, place): unit vectors and their places on the lines, for the rows that can link."""
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors, places = [], []
            for x in batch.column("embedding"):
                one = np.asarray(x.values.to_numpy(zero_copy_only=False), float) if x.is_valid else np.zeros(0)
                if one.size == 0 or not np.isfinite(one).all() or not one.any():
                    vectors.append(None)
                    places.append(None)
                    continue
                one = one / np.abs(one).max()  # no overflow in the norm
                one /= np.sqrt((one * one).sum())
                if one.size not in lines:
                    lines[one.size] = np.random.default_rng([seed, one.size]).standard_normal((one.size, plan.lines))
                vectors.append(one.tobytes())
                places.append(one @ lines[one.size])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(vectors, pa.binary()), pa.array(places, pa.list_(pa.float64()))], names=["vec_id", "label", "vector", "place"])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(project, f"vec_id long, label {kind}, vector binary, place array<double>").where("vector IS NOT NULL")


def near_pairs(groups: DataFrame, plan: Plan, cosine: float = COSINE) -> DataFrame:
    """(a, n, b): for each vector gid met in a tile: n other rows linked to it there (with their weights), and links
    (a, b) that span what is linked there.

    groups: gid, label, vector, place, weight; vectors are distinct within a label.
    """
    # A line is cut into cells as wide as half a window: partners lie in the same cell or the next.
    # Cells of more than TILE vectors are split into tiles, each pair of which meets in one place.
    line = F.posexplode(F.slice("place", 1, plan.sorted_lines)).alias("line", "at")
    rows = groups.select("gid", "label", F.octet_length("vector").alias("dims"), line)
    rows = rows.withColumn("cell", F.floor(F.col("at") / plan.half).cast("long")).drop("at")
    key = ["line", "label", "dims", "cell"]
    tiles = rows.groupBy(*key).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    sized = rows.join(tiles, key).withColumn("tile", F.pmod(F.hash("gid"), F.col("tiles")))
    following = tiles.select(*key[:-1], (F.col("cell") - 1).alias("cell"), F.col("tiles").alias("next_tiles"))
    # As a home tile, a row meets all later tiles of its cell and all tiles of the next; as a guest it goes to the earlier ones.
    home = sized.join(following, key, "left").select("gid", *key, "tile", F.explode(F.concat(
        F.transform(F.sequence(F.col("tile"), F.col("tiles") - 1), lambda o: F.struct(F.lit(0).alias("step"), o.alias("other"))),
        F.transform(F.when(F.col("next_tiles") > 0, F.sequence(F.lit(0), F.col("next_tiles") - 1)).otherwise(F.expr("CAST(array() AS array<int>)")), lambda o: F.struct(F.lit(1).alias("step"), o.alias("other"))),
    )).alias("x")).select("gid", "line", "label", "dims", "cell", "tile", "x.step", "x.other", F.lit(True).alias("home"))
    before = tiles.select(*key[:-1], (F.col("cell") + 1).alias("cell"), F.col("tiles").alias("home_tiles"))
    guest = sized.withColumn("mine", F.col("tile")).select("gid", *key, "mine", F.explode(F.sequence(F.lit(0), F.col("tile"))).alias("tile")).where("tile < mine").select("gid", "line", "label", "dims", "cell", "tile", F.lit(0).alias("step"), F.col("mine").alias("other"), F.lit(False).alias("home"))
    over = sized.join(before, key).select("gid", "line", "label", "dims", (F.col("cell") - 1).alias("cell"), F.col("tile").alias("other"), F.explode(F.sequence(F.lit(0), F.col("home_tiles") - 1)).alias("tile")).select("gid", "line", "label", "dims", "cell", "tile", F.lit(1).alias("step"), "other", F.lit(False).alias("home"))
    meet = ["line", "label", "dims", "cell", "tile", "step", "other"]
    sent = home.unionByName(guest).unionByName(over).join(groups.select("gid", "vector", "place", "weight"), "gid")
    sent = sent.withColumn("meeting", F.xxhash64(*meet)).select("meeting", *meet, "home", "gid", "vector", "place", "weight")
    spread = sent.repartition("meeting").sortWithinPartitions("meeting", *meet, F.col("home").desc(), "gid")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def links() -> pa.RecordBatch:
            line, tile, step, other = now[1], now[5], now[6], now[7]
            mine, theirs = [h for h in held if h[0]], [h for h in held if not h[0]]
            alone = step == 0 and other == tile
            theirs = mine if alone else theirs
            held.clear()
            counts: dict[int, int] = {}
            span: list[tuple[int, int]] = []
            if mine and theirs:
                ga, gb = (np.asarray([h[1] for h in x], np.int64) for x in (mine, theirs))
                va, vb = (np.stack([np.frombuffer(h[2], float) for h in x]) for x in (mine, theirs))
                pa_, pb = (np.asarray([h[3] for h in x], float) for x in (mine, theirs))
                wa, wb = (np.asarray([h[4] for h in x], np.int64) for x in (mine, theirs))
                order = np.argsort(pb[:, line], kind="stable")
                gb, vb, pb, wb = gb[order], vb[order], pb[order], wb[order]
                first = np.argsort(pa_[:, line], kind="stable")
                ga, va, pa_, wa = ga[first], va[first], pa_[first], wa[first]
                na, nb = np.zeros(len(ga), np.int64), np.zeros(len(gb), np.int64)
                for s in range(0, len(ga), STRIPE):
                    e = min(s + STRIPE, len(ga))
                    lo = np.searchsorted(pb[:, line], pa_[s, line] - plan.half, side="left")
                    hi = np.searchsorted(pb[:, line], pa_[e - 1, line] + plan.half, side="right")
                    if lo == hi:
                        continue
                    i, j = np.nonzero(np.abs(pa_[s:e, line][:, None] - pb[lo:hi, line][None, :]) <= plan.half)
                    i, j = i + s, j + lo
                    keep = ga[i] < gb[j] if alone else np.ones(len(i), bool)
                    i, j = i[keep], j[keep]
                    missed = np.zeros(len(i), np.int64)
                    for k in range(plan.lines):
                        if k == line:
                            continue
                        off = np.abs(pa_[i, k] - pb[j, k]) > plan.half
                        # A pair is looked at along the first line on which it collides.
                        missed += off
                        keep = (off if k < line else missed <= plan.lines - plan.count) & (missed <= plan.lines - plan.count)
                        i, j, missed = i[keep], j[keep], missed[keep]
                    near = np.einsum("ij,ij->i", va[i], vb[j]) >= cosine
                    i, j = i[near], j[near]
                    np.add.at(na, i, wb[j])
                    np.add.at(nb, j, wa[i])
                    span += _forest(ga[i], gb[j])
                for g, n in (*zip(ga.tolist(), na.tolist(), strict=True), *zip(gb.tolist(), nb.tolist(), strict=True)):
                    if n:
                        counts[g] = counts.get(g, 0) + n
                span = _forest(*np.asarray(span, np.int64).reshape(-1, 2).T)
            a = [*counts, *[x for x, _ in span]]
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array([*counts.values(), *[None] * len(span)], pa.int64()), pa.array([None] * len(counts) + [y for _, y in span], pa.int64())], names=["a", "n", "b"])

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("meeting", *meet)), strict=True))
            columns = (batch.column(c).to_pylist() for c in ("home", "gid", "vector", "place", "weight"))
            for key, *row in zip(keys, *columns, strict=True):
                if key != now and held:
                    yield links()
                now = key
                held.append(row)
        if held:
            yield links()

    return spread.mapInArrow(compare, "a long, n long, b long")


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of links, as few as connect the same."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root.setdefault(up, up)
            x = root[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, plan: Plan | None = None, seed: int = 11) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector.

    vectors: vec_id, embedding (array of numbers), label. Vectors of equal labels and lengths link
    when their cosine in double precision is cosine or more and the pair is found; a borderline
    pair is found with the plan's recall, closer ones more often. Null, empty and zero vectors, those
    with null or non-finite components, and those without a label link with nothing. Equal vectors are
    one from the start and count as many. Rows without vec_id take part: component_id is the
    smallest vec_id reachable, null if there is none, and kept is false for them. Repeated rows link
    with each other. Other columns are left out.
    """
    plan = plan or calibrated(cosine)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding"))
    found = stored(_projected(rows.where("label IS NOT NULL"), plan, seed), "projected")
    many = found.groupBy("label", "vector").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"), F.first("place").alias("place"))
    many = stored(many.withColumn("gid", F.xxhash64("label", "vector")), "groups")
    met = stored(near_pairs(many, plan, cosine), "met")
    outside = met.where("b IS NULL").groupBy(F.col("a").alias("gid")).agg(F.sum("n").alias("outside"))
    joined = components(met.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "gid")
    groups = many.select("gid", "label", "vector", "weight", "least").join(outside, "gid", "left").join(joined, "gid", "left")
    groups = groups.withColumn("component", F.coalesce("component", "gid"))
    least = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = groups.join(least, "component").select("gid", (F.col("weight") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"), "component_id")
    members = found.select("vec_id", F.xxhash64("label", "vector").alias("gid")).join(linked, "gid").select("vec_id", "n_links", "component_id")
    singles = _others(rows, found)
    out = members.unionByName(singles)
    return out.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _others(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The vectors that can't link, as rows of their own."""
    size = F.aggregate("embedding", F.lit(0.0), lambda acc, x: F.greatest(acc, F.when(x.isNull() | F.isnan(x.cast("double")), float("inf")).otherwise(F.abs(x.cast("double")))))
    largest = F.when(F.col("embedding").isNull() | (F.size("embedding") == 0), 0.0).otherwise(size)
    usable = F.col("label").isNotNull() & (largest > 0) & (largest < float("inf"))
    return rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
