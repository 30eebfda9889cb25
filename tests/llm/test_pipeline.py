import os

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from critiq.llm import chosen_path, queries
from tests.conftest import SF_SMALL
from tests.llm.conftest import SCHEMA, prose

NAMES = ["quality", "lines", "near_duplicates", "secrets", "packing"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, edge_docs):
    """A small folder of tables: clean documents, junk, copies, repeated lines, secrets, edge rows."""
    out = str(tmp_path_factory.mktemp("tables"))
    rows, marks = [], []
    for i in range(120):
        good = i % 3 > 0
        text = prose(i, 40 + i % 40) + "." if good else " | ".join(prose(i, 30).upper().split()) + "!!"
        rows.append((i, text, "en", "s", len(text)))
        marks.append((i, int(good), 0))
    copy = prose(1, 41) + "."
    rows += [(200, copy, "en", "s", len(copy)), (201, copy.replace("on ", "on\n", 1), "en", "s", len(copy)),
             (202, prose(77, 60) + " password = abcdef0123456789abcd.", "en", "s", 1)]
    for r in edge_docs.collect():
        rows.append((None if r.doc_id is None else 300 + r.doc_id, r.text, r.lang, r.source, r.n_chars))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out


def test_stages_take_effect_one_after_another(spark, tables, tmp_path):
    assert [n for n, _ in P.STAGES] == NAMES
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    seen = {}
    for name, stage in P.STAGES:
        out = str(tmp_path / name)
        result = stage(spark, docs, tables)
        if name != NAMES[-1]:
            assert result.columns == docs.columns
        result.write.parquet(out)
        docs = spark.read.parquet(out)
        seen[name] = {r.doc_id: r for r in docs.collect()}
    assert all(i not in seen["quality"] for i in range(0, 120, 3))
    assert all(i in seen["quality"] for i in range(120) if i % 3)
    assert seen["lines"].keys() == seen["quality"].keys() and seen["lines"][200].text == ""
    assert seen["lines"][200].n_chars == 0 and seen["lines"][1].text == copy_of(1)
    assert all(i in seen["near_duplicates"] for i in range(120) if i % 3)
    assert "[REDACTED]" in seen["secrets"][202].text and "abcdef0123" not in seen["secrets"][202].text
    assert seen["secrets"].keys() == seen["near_duplicates"].keys()
    assert set(seen["packing"]) == set(seen["secrets"])


def copy_of(i):
    return prose(i, 40 + i % 40) + "."


def test_near_duplicate_stage_keeps_one_of_each_group(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = [r.doc_id for r in P.near_duplicates(spark, docs, tables).collect()]
    want = [r.doc_id for r in chosen_path.near_groups(docs, 5).collect() if r.kept]
    assert sorted(kept, key=str) == sorted(want, key=str) and 200 not in kept and 201 not in kept and 1 in kept


def test_run_equals_the_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, tables).collect(), docs.schema)
    want = P.packed(spark, docs, tables)
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = P.run(spark, tables)
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_stages_on_empty_tables(spark, no_docs, tables, name, stage):
    assert stage(spark, no_docs, tables).collect() == []


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) <= set(E.queries()) and "pipeline" in E.queries()
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES) and set(queries.ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")
def test_topk_query_matches_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    want = sorted(con.sql(queries.ORACLE_SQL["op7_pivot_topk"]).fetchall())
    assert sorted(map(tuple, queries.op7_pivot_topk(spark, SF_SMALL).collect())) == want
