"""Every catalogue query against its DuckDB oracle at sf0.001 (the
driver's correctness gate runs the same comparison at sf0.01)."""

import re

import duckdb
import pytest

import __spark_entry__ as E
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"
NAMES = sorted(n for n in E.oracle_sql() if n != "pipeline" and not re.match(r"op\d", n))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_is_registered():
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    own = {q for q in qs if q != "pipeline" and not q.startswith("op")}
    assert own <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["area", "record_count", "avg_amount", "max_amount"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
