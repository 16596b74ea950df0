"""Order-dependent operators that survive a group holding a third of all rows.

A plain ``Window.partitionBy(key).orderBy(...)`` puts a whole group into one
task. The functions here cut a group into consecutive *chunks* first. The chunk
is a deterministic, order-preserving function of the ordering columns, so it
needs no sampling and gives the same answer when a lost executor makes Spark
recompute a task. Windows then run per (key, chunk), and one small summary row
per chunk carries the state from a chunk to the next.

NULL is a chunk of its own, the lowest: ascending order puts it first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.sinks.scratch import kept

# Frames per chunk when the position inside the episode is already known.
FRAMES_PER_CHUNK = 1 << 16


def minute_of(df: DataFrame, column: str) -> Column:
    """Minutes since the epoch, never decreasing with the timestamp."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        # Field extraction keeps the session time zone out of it.
        days = F.unix_date(F.to_date(c)).cast("long")
        return days * 1440 + F.hour(c) * 60 + F.minute(c)
    return F.floor(F.unix_micros(c) / F.lit(60_000_000)).cast("long")


def hour_of(df: DataFrame, column: str) -> Column:
    """Hours since the epoch, never decreasing with the timestamp."""
    return F.floor(minute_of(df, column) / 60).cast("long")


def running_totals(
    df: DataFrame,
    measures: Mapping[str, Column],
    order_by: Sequence[Column | str],
    chunk: str | Sequence[str] = "chunk",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running sums of ``measures`` per partition, in order.

    ``chunk`` names leading (or order-preserving) columns of ``order_by``. Rows
    are summed up inside a chunk by a window; sums of earlier chunks come from a
    per-chunk aggregate, which Spark combines on the map side.
    """
    parts = list(partition_by)
    chunks = [chunk] if isinstance(chunk, str) else list(chunk)
    for name, measure in measures.items():
        df = df.withColumn(name, measure)
    kept = [c for c in df.columns if c not in measures]
    # A struct compares field by field and is never NULL itself, so the window and the
    # join ask for the same partitioning: rows are shuffled once.
    df = df.withColumn("__at", F.struct(*parts, *chunks))
    of = lambda name: F.col("__at").getField(name)

    per_chunk = df.groupBy("__at").agg(*[F.sum(name).alias(f"__sum_{name}") for name in measures])
    before = Window.partitionBy(*map(of, parts)).orderBy(*map(of, chunks)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_chunk.select(
        "__at",
        *[F.sum(f"__sum_{name}").over(before).alias(f"__before_{name}") for name in measures],
    )

    inside = (
        Window.partitionBy("__at")
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = df.select("__at", *kept, *[F.sum(name).over(inside).alias(name) for name in measures])
    return summed.join(offsets, "__at", "left").select(
        *kept,
        *[
            (F.col(name) + F.coalesce(F.col(f"__before_{name}"), F.lit(0))).alias(name)
            for name in measures
        ],
    )


def neighbours(
    df: DataFrame,
    columns: Sequence[str],
    partition_by: str,
    order_by: str,
    chunk: str = "chunk",
) -> DataFrame:
    """Add ``prev_<c>`` and ``next_<c>``: the row before and after in the group.

    Windows see one chunk; the rows at chunk edges get their neighbour from a
    summary that keeps two rows per chunk and only for groups with many chunks.
    """
    inside = Window.partitionBy(partition_by, chunk).orderBy(order_by)
    wide = df
    for c in columns:
        wide = wide.withColumn(f"prev_{c}", F.lag(c).over(inside)).withColumn(
            f"next_{c}", F.lead(c).over(inside)
        )
    wide = wide.withColumn("__first", F.lag(F.lit(1)).over(inside).isNull()).withColumn(
        "__last", F.lead(F.lit(1)).over(inside).isNull()
    )

    packed = F.struct(*[F.col(c) for c in columns])
    across = Window.partitionBy("__ep").orderBy("__chunk")
    edges = (
        df.groupBy(F.col(partition_by).alias("__ep"), F.col(chunk).alias("__chunk"))
        .agg(
            F.min_by(packed, order_by).alias("head"),
            F.max_by(packed, order_by).alias("tail"),
        )
        .select(
            "__ep",
            "__chunk",
            F.lag("tail").over(across).alias("__before"),
            F.lead("head").over(across).alias("__after"),
        )
        .where(F.col("__before").isNotNull() | F.col("__after").isNotNull())
    )
    joined = wide.join(
        edges,
        F.col(partition_by).eqNullSafe(F.col("__ep")) & F.col(chunk).eqNullSafe(F.col("__chunk")),
        "left",
    )
    added = []
    for c in columns:
        added.append(
            F.when(F.col("__first"), F.col(f"__before.{c}"))
            .otherwise(F.col(f"prev_{c}"))
            .alias(f"prev_{c}")
        )
        added.append(
            F.when(F.col("__last"), F.col(f"__after.{c}"))
            .otherwise(F.col(f"next_{c}"))
            .alias(f"next_{c}")
        )
    return joined.select(*df.columns, *added)


# Fixed value: added to a number so that its hexadecimal digits sort as it does.
LONG_SIGN = -(1 << 63)


def sort_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """A text that sorts, byte by byte, as these columns do ascending, NULL first.

    Whole numbers, dates, times and texts; a text ends with the least character, which
    it must not hold itself.
    """
    parts = []
    for name in columns:
        kind, c = df.schema[name].dataType, F.col(name)
        if isinstance(kind, T.StringType):
            digits = F.concat(c, F.lit("\x00"))
        else:
            if isinstance(kind, T.TimestampType):
                number = F.unix_micros(c)
            elif isinstance(kind, T.TimestampNTZType):
                day = F.unix_date(F.to_date(c)).cast("long") * 86_400_000_000
                number = day + F.expr(
                    f"(hour(`{name}`) * 3600 + minute(`{name}`) * 60) * 1000000L"
                    f" + cast(extract(SECOND FROM `{name}`) * 1000000 AS bigint)"
                )
            elif isinstance(kind, T.DateType):
                number = F.unix_date(c).cast("long")
            elif isinstance(kind, T.IntegralType):
                number = c.cast("long")
            else:
                raise TypeError(f"{name}: no sort key for {kind.simpleString()}")
            digits = F.lpad(F.hex(number.bitwiseXOR(F.lit(LONG_SIGN))), 16, "0")
        parts.append(F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), digits)))
    return F.concat(*parts)


# Rows of a chunk at most, unless they share a sort key.
ROWS_PER_CHUNK = 50_000
# Characters by which a full chunk is cut beyond what all its keys begin with.
CUT_BY = 2
# A list of full chunks up to this long is sent to all tasks; a longer one is joined.
SENT_CHUNKS = 10_000


def split_by_key(
    df: DataFrame,
    key: str,
    partition_by: Sequence[str] = (),
    most: int = ROWS_PER_CHUNK,
    chunk: str = "chunk",
) -> DataFrame:
    """Add ``chunk``: a beginning of the text ``key`` that at most ``most`` rows of a group share.

    A histogram of the keys that grows where it is full: rows are counted per group, then
    per beginning of the key in groups with too many rows, then by longer ones where
    there are still too many. A full cell is cut just beyond what all its keys have in
    common, so every round splits it. Chunks sort as their keys do: a short one is shared
    by all keys that begin with it. Equal keys stay together. ``df`` is read once per
    round; counts are combined on the map side, whatever the skew.
    """
    parts = list(partition_by)
    rows = df.withColumn(chunk, F.lit(""))
    active = rows
    while True:
        full = kept(_full_cells(active, key, parts, chunk, most))
        many = full.count()
        if not many:
            return rows
        if many <= SENT_CHUNKS:
            full = F.broadcast(full)
        on = [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in parts]
        joined = rows.join(full, [*on, F.col(chunk) == F.col("__prefix")], "left")
        cut = F.when(F.col("__cut").isNotNull(), F.substring(key, F.lit(1), F.col("__cut")))
        rows = joined.withColumn(chunk, F.coalesce(cut, F.col(chunk)))
        active = rows.where("__cut IS NOT NULL").select(*df.columns, chunk)
        rows = rows.select(*df.columns, chunk)


def _full_cells(
    rows: DataFrame, key: str, parts: list[str], chunk: str, most: int
) -> DataFrame:
    """(__parts, __prefix, __cut): cells with too many rows, and where to cut their keys."""
    cells = rows.groupBy(*parts, chunk).agg(
        F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
    )
    shorter = "least(length(low), length(high))"
    differ = (
        f"array_position(transform(sequence(1, {shorter}),"
        " i -> substring(low, i, 1) <> substring(high, i, 1)), true)"
    )
    common = f"CASE WHEN {shorter} = 0 THEN 0 ELSE coalesce(nullif({differ}, 0) - 1, {shorter}) END"
    return cells.where((F.col("n") > most) & (F.col("low") < F.col("high"))).select(
        *[F.col(p).alias(f"__{p}") for p in parts],
        F.col(chunk).alias("__prefix"),
        F.expr(f"cast({common} + {CUT_BY} AS int)").alias("__cut"),
    )


def first_rows(
    df: DataFrame, n: int, order_by: Sequence[str], most: int = ROWS_PER_CHUNK
) -> DataFrame:
    """The first ``n`` rows in order, found without bringing rows together.

    Counts per chunk of the sort key and their running sums show in which chunk the n-th
    row is; the keys of that chunk give its key. What remains is a filter on the rows
    where they lie. Rows of equal sort columns are ordered by a hash of the whole row.
    """
    if n <= 0:
        return df.limit(0)
    whole = F.concat(sort_key(df, order_by), F.hex(F.xxhash64(*df.columns)))
    keyed = kept(df.select(whole.alias("key")))
    cut = kept(split_by_key(keyed, "key", most=most))
    upto = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Unpartitioned on purpose: one row per chunk.
    summed = cut.groupBy("chunk").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(upto))
    last = summed.where(F.col("upto") >= n).orderBy("chunk").select("chunk", "n", "upto").first()
    if last is None:
        return df
    rest = n - (last["upto"] - last["n"])
    inside = cut.where(F.col("chunk") == last["chunk"]).groupBy("key").agg(F.count("*").alias("n"))
    # At most ``most`` different keys.
    reached = inside.withColumn("upto", F.sum("n").over(Window.orderBy("key")))
    at = reached.where(F.col("upto") >= rest).orderBy("key").first()
    missing = at["n"] - (at["upto"] - rest)
    if missing == at["n"]:
        return df.where(whole <= at["key"])
    one = df.where(whole == at["key"]).limit(1)
    copies = one.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(missing)))).drop("__copy")
    return df.where(whole < at["key"]).unionByName(copies)
