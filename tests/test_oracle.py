"""Every registered query against its DuckDB oracle on the small driver tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from slotwise.sources.tables import DRIVER_TABLES

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    from slotwise.plans import catalog
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["booking_date", "channel", "bookings_count", "booking_week"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if not n.startswith("op")))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    sdf = QUERIES[name](spark, sf_dir)
    srows = [r.asDict() for r in sdf.collect()]
    cur = duck.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    orows = [dict(zip(ocols, r)) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    cols = sorted(ocols)
    assert _rows(srows, cols) == _rows(orows, cols)


def test_scan_filters_reach_the_files(spark, sf_dir):
    """One plan at every size: no shuffle between a scan and its filter."""
    plan = QUERIES["bookings_enriched"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" not in plan and "Exchange" not in plan
