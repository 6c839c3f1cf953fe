"""Registered queries against their DuckDB SQL on whole small tables."""

import math

import duckdb
import pytest

from nightshift.llm.oracles import ORACLE_SQL
from nightshift.llm.queries import QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(round(x, 9))
        return repr(x)

    return sorted("|".join(v(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, name, size):
    sf = f"/root/testdata/{size}"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = QUERIES[name](spark, sf)
    want = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(cols)
    mine = _norm([tuple(r) for r in got.collect()], got.columns)
    assert mine == _norm(want.fetchall(), cols)
    assert mine
