"""The queries of this package that SQL can state, against their SQL on the small tables."""

from __future__ import annotations

import duckdb
import pytest

from slotwise.llm.queries import ORACLES, QUERIES
from slotwise.sources.tables import DRIVER_TABLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    found = QUERIES[name](spark, sf_dir)
    wanted = con.execute(ORACLES[name])
    names = [d[0] for d in wanted.description]
    assert sorted(found.columns) == sorted(names)
    as_rows = lambda rows, at: sorted((tuple(r[at.index(c)] for c in sorted(names)) for r in rows), key=repr)
    assert as_rows(found.collect(), found.columns) == as_rows(wanted.fetchall(), names)
