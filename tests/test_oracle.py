"""Every registered query equals its DuckDB oracle (rows, columns, values)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from payflux import catalog
from tools.check_oracle import compare, duck

# the corpus queries, where present, have tests of their own
QUERIES = {k: v for k, v in entry.queries().items() if k in catalog.QUERIES}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in catalog.QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


# Spark type -> DuckDB type name of the same values
DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    ok, msg = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert ok, msg
    # same column types, so value hashes agree too
    rel = con.sql(SQL[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in df.schema.fields:
        spark_t = f.dataType.simpleString()
        assert DUCK_TYPE.get(spark_t, spark_t) == duck_types[f.name], (f.name, spark_t, duck_types[f.name])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["verdict", "n"]
    assert sum(r["n"] for r in df.collect()) == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
