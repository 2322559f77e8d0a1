"""Every query with a SQL twin gives the same rows as DuckDB (sf0.001)."""

import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL
from tastemap.sources.tables import TABLES, table_path

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from tools.oracle_check import digest  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    con.execute(f"CREATE OR REPLACE VIEW wanted AS {entry.oracle_sql()[name]}")
    want = con.sql("SELECT * FROM wanted").df()
    assert digest(got) == digest(want)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert [r["split"] for r in rows] == ["val", "test"]
    assert all(0.0 <= r["precision_at_k"] <= 1.0 for r in rows)


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
                   "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_types_match_sql(spark, con, name):
    got = {c: SPARK_TO_DUCKDB.get(t, t) for c, t in entry.queries()[name](spark, SF_SMALL).dtypes}
    rel = con.sql(entry.oracle_sql()[name])
    want = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert got == want
