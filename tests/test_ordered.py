"""Chunked operators against plain windows, with very skewed groups."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gaugeline.operators import ordered
from gaugeline.plans import reports


@pytest.fixture(scope="module")
def skewed(spark):
    """Group 0 holds well over a third of the rows; group 9 has one row."""
    rng = random.Random(5)
    rows = []
    for i in range(600):
        g = 0 if i % 2 else rng.randrange(1, 8)
        rows.append((g, i // 7 * 20, i, rng.randrange(10), None if rng.random() < 0.3 else i))
    rows.append((9, 5, 1000, 3, None))
    return spark.createDataFrame(rows, "g int, second int, id int, v int, maybe int").withColumn(
        "ts", F.timestamp_seconds(F.col("second"))
    )


@pytest.mark.parametrize("bucket", ["minute", "hour"])
def test_running_totals_equal_a_plain_window(skewed, bucket):
    """A tenth of the rows has no time, and all rows of a group may share one second."""
    ts = F.when(F.col("id") % 10 != 3, F.when(F.col("g") == 2, F.lit("2024-01-01")).otherwise(F.col("ts")))
    timed = skewed.withColumn("ts", ts.cast("timestamp"))
    of = {"minute": ordered.minute_of, "hour": ordered.hour_of}[bucket]
    found = ordered.running_totals(
        timed.withColumn("chunk", of(timed, "ts")),
        {"nth": F.lit(1).cast("long"), "total": F.col("v").cast("long")},
        order_by=["ts", "id"],
        partition_by=["g"],
    )
    w = Window.partitionBy("g").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    wanted = timed.select("id", F.count("*").over(w), F.sum("v").over(w))
    assert sorted(found.select("id", "nth", "total").collect()) == sorted(wanted.collect())


def test_tally_counts_rows_without_a_time(spark):
    df = spark.range(300).selectExpr(
        "cast(id AS string) AS episode_id",
        "CASE WHEN id % 2 = 0 THEN timestamp_seconds(id * 20) END AS ingested_at",
        "'CERTIFIED' AS routing_decision",
    )
    got = reports.running_tally(df, every=50)
    assert sorted(r["n"] for r in got.collect()) == [50, 100, 150, 200, 250, 300]


def test_percentiles_put_nan_last(spark):
    df = spark.range(100).selectExpr("CASE WHEN id < 66 THEN cast(id AS double) ELSE double('NaN') END AS x")
    assert reports.index_percentiles(df, "x", (0.5, 0.65)).first() == (50.0, 65.0)


def test_running_totals_without_groups(skewed):
    found = ordered.running_totals(
        skewed.withColumn("chunk", ordered.minute_of(skewed, "ts")),
        {"nth": F.lit(1).cast("long")},
        order_by=["ts", "id"],
    )
    ids = [r["id"] for r in skewed.orderBy("ts", "id").collect()]
    assert [r["id"] for r in found.orderBy("nth").collect()] == ids
    assert [r["nth"] for r in found.orderBy("nth").collect()] == list(range(1, len(ids) + 1))


@pytest.mark.parametrize("size", [1, 4, 50, 1000])
def test_neighbours_equal_lag_and_lead(skewed, size):
    placed = skewed.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("id")))
    cut = placed.withColumn("chunk", F.floor(F.col("pos") / size))
    found = ordered.neighbours(cut, ["v", "maybe"], "g", "pos")
    w = Window.partitionBy("g").orderBy("pos")
    wanted = placed.select(
        "id",
        F.lag("v").over(w),
        F.lead("v").over(w),
        F.lag("maybe").over(w),
        F.lead("maybe").over(w),
    )
    got = found.select("id", "prev_v", "next_v", "prev_maybe", "next_maybe")
    key = lambda r: r[0]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(
        map(tuple, wanted.collect()), key=key
    )


def test_minute_bucket_never_decreases(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'1969-12-31 23:59:59.9' + make_interval(0,0,0,0,0,0,id * 17) AS a,"
        " timestamp'1969-12-31 23:59:59.9' + make_interval(0,0,0,0,0,0,id * 17) AS b"
        " FROM range(40)"
    )
    for c in ("a", "b"):
        got = [r[0] for r in df.orderBy(c).select(ordered.minute_of(df, c)).collect()]
        assert got == sorted(got) and got[0] == -1 and got[1] == 0


@pytest.mark.parametrize("most", [1, 7, 100, 5000])
def test_chunks_keep_the_order_and_are_small(spark, most):
    rng = random.Random(3)
    texts = ["GAP(%.1fms max, %d violations)" % (rng.random() * 500, rng.randrange(4)) for _ in range(800)]
    texts += ["", "G", "GAP(", "é", "é1", "\U0001f600"] + ["same"] * 40
    rows = [(rng.choice([None, 1, 2, 2, 2]), t) for t in texts]
    df = spark.createDataFrame(rows, "g int, key string")
    got = [tuple(r) for r in ordered.split_by_key(df, "key", ["g"], most).select("g", "key", "chunk").collect()]
    assert sorted((g or 0, k) for g, k, _ in got) == sorted((g or 0, k) for g, k in rows)
    for g in (None, 1, 2):
        mine = sorted(((k, c) for h, k, c in got if h == g), key=lambda x: x[0].encode())
        assert [c for _, c in mine] == sorted((c for _, c in mine), key=str.encode)
        assert all(k.startswith(c) for k, c in mine)
        sizes = {}
        for k, c in mine:
            sizes.setdefault(c, set()).add(k)
        assert all(len(ks) == 1 or sum(c == d for _, d in mine) <= most for c, ks in sizes.items())


def test_sort_keys_sort_as_their_columns(spark):
    import datetime as dt

    rng = random.Random(8)
    times = [None, dt.datetime(1969, 12, 31, 23), dt.datetime(2024, 5, 1, 1, 2, 3, 456789), dt.datetime(2024, 5, 1)]
    rows = [(rng.choice([None, -5, 0, 7, -(2**63), 2**63 - 1]), rng.choice([None, "", "a", "ab", "b", "é"]), rng.choice(times)) for _ in range(300)]
    df = spark.createDataFrame(rows, "n long, s string, t timestamp").withColumn("d", F.to_date("t")).withColumn("z", F.col("t").cast("timestamp_ntz"))
    names = ["n", "s", "t", "d", "z"]
    keys = df.select(*names, ordered.sort_key(df, names).alias("key"))
    by_key = [tuple(r)[:5] for r in keys.orderBy("key").collect()]
    assert by_key == [tuple(r)[:5] for r in keys.orderBy(*names).collect()]
    with pytest.raises(TypeError):
        ordered.sort_key(df.withColumn("x", F.lit(1.5)), ["x"])


@pytest.mark.parametrize("n", [0, 1, 5, 13, 500, 1000, 1041, 5000])
def test_first_rows_equal_a_limit(spark, n):
    """Half the table and more, ties, and one row many times over."""
    df = spark.range(1000).selectExpr("id % 7 AS a", "CASE WHEN id % 5 > 0 THEN cast(id % 11 AS string) END AS b", "id")
    df = df.unionByName(spark.range(41).selectExpr("0L AS a", "'1' AS b", "-1L AS id"))
    got = ordered.first_rows(df, n, ["a", "b"], most=50)
    wanted = df.orderBy("a", "b").limit(n)
    assert got.count() == wanted.count() == min(n, 1041)
    assert sorted(map(str, got.select("a", "b").collect())) == sorted(map(str, wanted.select("a", "b").collect()))
    # Which of the ties come is settled: a longer list has the shorter one.
    if 0 < n < 1041:
        longer = ordered.first_rows(df, n + 1, ["a", "b"], most=50)
        assert got.exceptAll(longer).count() == 0


def test_payloads_are_not_brought_together(spark):
    df = spark.range(2000).selectExpr("id % 300 AS k", "id", "repeat('x', 100) AS payload")
    plan = ordered.first_rows(df, 1000, ["k", "id"], most=100)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "TakeOrdered" not in plan


def test_ranks_of_a_hot_day_run_in_many_tasks(spark):
    """One day and task with 60,000 flags that begin alike and affect as many: chunks stay small, ranks are row numbers."""
    from gaugeline.plans import gold

    df = spark.range(60_000).selectExpr(
        "date'2024-05-01' AS report_date",
        "CASE WHEN id % 50 < 49 THEN 'hot' END AS task_type",
        "'REJECTED' AS routing_decision",
        "concat('TEMPORAL_COHERENCE:GAP(1', hash(id), 'ms max)') AS failure_flag",
        "2L AS affected_episodes",
    )
    got = gold.rank_failures(df, most=1000)
    w = Window.partitionBy("report_date", "task_type").orderBy(F.desc("affected_episodes"), "routing_decision", "failure_flag")
    wanted = df.withColumn("failure_rank", F.row_number().over(w))
    columns = sorted(got.columns)
    assert columns == sorted(wanted.columns)
    assert got.select(columns).exceptAll(wanted.select(columns)).count() == 0 and got.count() == 60_000
    keyed = df.withColumn("key", ordered.sort_key(df, ["failure_flag"]))
    sizes = [r["count"] for r in ordered.split_by_key(keyed, "key", ["task_type"], 1000).groupBy("task_type", "chunk").count().collect()]
    assert max(sizes) <= 1000 and len(sizes) > 60
