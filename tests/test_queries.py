"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, db, name):
    got = contract.queries()[name](spark, SF).toArrow()
    if name in contract.oracle_sql():
        want = db.sql(contract.oracle_sql()[name]).to_arrow_table()
        assert rows_of(got) == rows_of(want)
    assert got.num_rows > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
