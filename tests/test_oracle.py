"""Every registered query against its DuckDB SQL on the smallest test data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, table_hash

SF = os.environ.get("SYLVAN_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    from sylvan.plans.queries import QUERIES

    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    d_cols, d_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert table_hash(s_cols, s_rows, 9) == table_hash(d_cols, d_rows, 9)


def test_entry_smoke(spark):
    out = entry.entry(spark)
    assert out.columns[:8] == [
        "dataset", "acc_species_name", "trait_value", "trait_domain", "trait_full_name",
        "observation_id", "orig_value_str", "unit_name",
    ]
    assert out.count() > 0


def test_entry_schema_is_stable(spark):
    assert entry.entry(spark).schema == entry.entry(spark).schema
