from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tests.helpers import SF_SMALL

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, name):
    frame = QUERIES[name](spark, SF_SMALL)
    got = rows_of(frame.columns, frame.collect())
    if name not in ORACLES:
        assert got
        return
    with duckdb.connect() as db:
        for file in Path(SF_SMALL).glob("*.parquet"):
            db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
        result = db.sql(ORACLES[name])
        assert sorted(frame.columns) == sorted(result.columns)
        assert got == rows_of(result.columns, result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 50
