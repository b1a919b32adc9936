"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from catalytics.plans.registry import QUERIES
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"feature_importance", "forest_metrics", "prepare_ml", "build_features"}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_oracle_or_is_ml():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert missing <= {"split_random", "feature_importance", "forest_metrics"}


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["p_brand", "p_type", "total_apps", "avg_installs"]
    assert df.count() > 0


def test_rows_only_queries(spark):
    n = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert E.queries()["split_random"](spark, SF_SMALL).count() == n
