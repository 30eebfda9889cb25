"""Spark and the SQL oracles agree on tables with unmatched keys and NULLs.

The test tables have no orphan keys, so unmatched-key policies are invisible there. This
builds a copy of the smallest tables where some customers and parts are missing (ratings
by unknown users, of unknown movies), some ratings are NULL, and some documents have NULL
id, language, text or source, then compares every registered query with its oracle on that copy.
"""

import os

import duckdb
import pytest

import __spark_entry__ as E
from critiq.plans import catalog
from tests.conftest import SF_SMALL
from tests.test_oracle import SPARK_TO_DUCK, TABLES, _bag

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")

EDITS = {
    "customer": "SELECT * FROM customer WHERE c_custkey % 7 <> 0",
    "part": """SELECT * REPLACE (CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_name END AS p_name)
               FROM part WHERE p_partkey % 11 <> 0""",
    "nation": """SELECT * REPLACE (CASE WHEN n_nationkey % 4 = 1 THEN NULL ELSE n_name END AS n_name) FROM nation""",
    "orders": "SELECT * FROM orders WHERE o_orderkey % 29 <> 0",
    "lineitem": """SELECT * REPLACE (CASE WHEN l_orderkey % 5 = 0 AND l_linenumber = 2 THEN NULL
                                          ELSE l_quantity END AS l_quantity)
                   FROM lineitem""",
    "documents": """SELECT CASE WHEN doc_id % 23 = 0 THEN NULL ELSE doc_id END AS doc_id,
                           CASE WHEN doc_id % 17 = 0 THEN NULL ELSE text END AS text,
                           CASE WHEN doc_id % 13 = 0 THEN NULL ELSE lang END AS lang,
                           CASE WHEN doc_id % 19 = 0 THEN NULL ELSE source END AS source,
                           n_chars
                    FROM documents""",
}


@pytest.fixture(scope="module")
def edge_dir(tmp_path_factory):
    out = tmp_path_factory.mktemp("edges")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for t in TABLES:
        con.sql(f"COPY ({EDITS.get(t, f'SELECT * FROM {t}')}) TO '{out}/{t}.parquet' (FORMAT PARQUET)")
    return str(out)


@pytest.fixture(scope="module")
def edge_duck(edge_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{edge_dir}/{t}.parquet')")
    return con


def test_edges_exist(edge_duck):
    orphans = edge_duck.sql("SELECT count(*) FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey "
                            "WHERE c.c_custkey IS NULL").fetchall()[0][0]
    assert orphans > 0


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle_on_edges(spark, edge_dir, edge_duck, name):
    df = E.queries()[name](spark, edge_dir)
    rows = [tuple(r) for r in df.collect()]
    res = edge_duck.sql(E.oracle_sql()[name])
    ocols, orows = res.columns, res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    assert stypes == dict(zip(ocols, [str(t) for t in res.types]))
    assert _bag(rows, df.columns) == _bag(orows, ocols)


def test_several_labels_give_a_row_each(spark, tmp_path):
    from critiq.sources import tables

    con = duckdb.connect()
    con.sql(f"COPY (SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')) TO '{tmp_path}/documents.parquet'")
    con.sql(f"""COPY (SELECT * FROM read_parquet('{SF_SMALL}/labels.parquet')
                    UNION ALL SELECT * FROM read_parquet('{SF_SMALL}/labels.parquet'))
                TO '{tmp_path}/labels.parquet'""")
    docs = tables.reviews(spark, str(tmp_path)).count()             # sentiment not asked for: labels not read
    labels = spark.read.parquet(str(tmp_path / "labels.parquet")).count() // 2
    assert tables.reviews(spark, str(tmp_path), sentiment=True).count() == docs + labels
