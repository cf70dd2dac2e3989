"""The registered corpus queries equal their DuckDB SQL on the small tables."""

import pytest

from payflux.llm.oracles import ORACLE_SQL
from payflux.llm.queries import QUERIES
from tools.check_oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck(SF).execute(ORACLE_SQL[name])
    ok, msg = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert ok, msg
