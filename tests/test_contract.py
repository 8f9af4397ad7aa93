"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import normalised

SF = "/root/testdata/sf0.001"
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    from pathlib import Path

    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


def test_every_query_has_its_sql():
    # a fitted forest has no SQL; its ranking of held-out days is tested instead
    assert {q for q in queries() if q.startswith("q_")} - {"q_incident_forest"} == {q for q in ORACLES if q.startswith("q_")}


@pytest.mark.parametrize("name", sorted(q for q in ORACLES if q.startswith("q_")))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, SF)
    got = normalised(df.columns, df.collect())
    result = duck.execute(ORACLES[name])
    assert got == normalised([d[0] for d in result.description], result.fetchall())
