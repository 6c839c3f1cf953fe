"""Every registered query against its DuckDB oracle SQL."""

import math
import os

import duckdb
import pytest

from nightshift.oracle import build
from nightshift.plans.queries import REGISTRY

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SQL = build()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        return repr(round(x, 6)) if isinstance(x, float) and not math.isnan(x) else repr(x)

    return sorted("|".join(v(r[i]) for i in order) for r in rows)


def test_every_query_has_oracle():
    missing = sorted(set(REGISTRY) - set(SQL))
    assert missing == []


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, sf, con, name):
    df = REGISTRY[name](spark, sf)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(SQL[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _norm(srows, scols) == _norm(orows, ocols)


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() >= 0 and "summary_date" in df.columns


SHUFFLE_PATH = ["daily_customer_summary", "daily_product_summary", "upsert_orders",
                "upsert_orderdetails", "upsert_employees", "scd2_customer_history",
                "monthly_customer_summary", "surrogate_keys"]


@pytest.mark.parametrize("name", SHUFFLE_PATH)
def test_shuffle_fallback_matches_oracle(spark, sf, con, name):
    """The same programs with every size-checked broadcast refused."""
    spark.conf.set("spark.nightshift.broadcastMaxRows", "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_query_matches_oracle(spark, sf, con, name)
    finally:
        spark.conf.unset("spark.nightshift.broadcastMaxRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
