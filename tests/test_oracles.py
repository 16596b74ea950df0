"""Every registered query against its oracle SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entries
from tools.compare import TABLES, compare

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entries.QUERIES, entries.ORACLES


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, con, name):
    line = compare(spark, con, SF, name, QUERIES[name], ORACLES[name])
    assert line.startswith("ok "), line


def test_entry(spark):
    assert entries.entry(spark).count() > 0


# Decision counts CERTIFIED / BORDERLINE / REJECTED fixed in advance.
@pytest.mark.parametrize("sf, wanted", [("sf0.001", (7, 1, 7)), ("sf0.01", (64, 12, 74))])
def test_decisions(spark, sf, wanted):
    found = QUERIES["routing"](spark, f"/root/testdata/{sf}").groupBy("routing_decision").count()
    counts = {r["routing_decision"]: r["count"] for r in found.collect()}
    assert tuple(counts.get(k, 0) for k in ("CERTIFIED", "BORDERLINE", "REJECTED")) == wanted
