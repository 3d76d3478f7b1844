"""Every query with an SQL twin gives the same rows as DuckDB at the smallest scale."""

import sys

import duckdb
import pytest

sys.path.insert(0, "tools")

from check_oracle import TABLES, bag, kind  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
TWINS = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(TWINS))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toArrow()
    want = duck.execute(TWINS[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    for c in got.column_names:
        assert kind(got.schema.field(c).type) == kind(want.schema.field(c).type), c
    assert bag(got) == bag(want)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)
