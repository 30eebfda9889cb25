"""Every registered query equals its DuckDB oracle on the smallest test tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from critiq.plans import catalog
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
                 "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.sql(E.oracle_sql()[name])
    ocols, orows = res.columns, res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    assert stypes == dict(zip(ocols, [str(t) for t in res.types]))
    assert _bag(rows, df.columns) == _bag(orows, ocols)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["rank", "genre", "avg_rating", "n"]
    assert [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1, len(rows) + 1))
