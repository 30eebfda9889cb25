"""Rejected lines: every bad line is kept with its reason, in one pass, whatever the ANSI setting."""

import os

import pytest
from pyspark.sql import types as T

from critiq import schemas
from critiq.sources import check_lines, read_ratings_checked, split_lines
from tests.conftest import explain_text

LINES = ["1, 10, 4.5, 1", "\t2 ,11,3.0 , 2", "3,12", "", "4,x,2.0,9", "5,13,,9", "6,14,1e1,9", "7,15,2.0,9,more", "x,y,z,w",
         "9999999999999999999999,1,1,1", None, "8,16,3.5,"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_reasons_and_counts(spark, scratch, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lines = spark.createDataFrame([(line, i) for i, line in enumerate(LINES)], "line string, no int").repartition(3)
        found = split_lines(check_lines(lines, schemas.RATINGS, keep=("no",)), os.path.join(scratch, "out"), schemas.RATINGS,
                            ("no",))
        assert sorted(map(tuple, found.accepted.collect())) == [
            (1, 10, 4.5, 1, 0), (2, 11, 3.0, 2, 1), (6, 14, 10.0, 9, 6)]
        assert sorted(((r.no, r.reason, r.detail) for r in found.rejected.collect())) == [
            (2, "short", "2 of 4 fields"), (3, "short", "1 of 4 fields"), (4, "bad number", "movie_id: x"),
            (5, "bad number", "rating: "), (7, "bad number", "ts: 9,more"), (8, "bad number", "user_id: x"),
            (9, "bad number", "user_id: 9999999999999999999999"), (10, "short", "0 of 4 fields"), (11, "bad number", "ts: ")]
        assert {r.no: r.line for r in found.rejected.collect()} == {
            i: LINES[i] for i in (2, 3, 4, 5, 7, 8, 9, 10, 11)}
        assert found.counts == {"read": 12, "accepted": 3, "short": 3, "bad number": 6}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_each_output_reads_its_own_folder(spark, scratch):
    lines = spark.createDataFrame([("1,a",), ("x,b",)], "line string")
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("t", T.StringType())])
    out = os.path.join(scratch, "out")
    found = split_lines(check_lines(lines, schema), out, schema)
    assert sorted(os.listdir(out))[-2:] == ["accepted=false", "accepted=true"]
    for df in (found.accepted, found.rejected):
        plan = explain_text(df, "formatted")
        assert "PartitionFilters: [isnotnull(accepted" in plan
    assert [tuple(r) for r in found.accepted.collect()] == [(1, "a")]


@pytest.mark.parametrize("lines", [[], ["1,2,3,4"], ["bad"]])
def test_one_sided_and_empty_inputs(spark, scratch, lines):
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    found = split_lines(check_lines(df, schemas.RATINGS), os.path.join(scratch, "out"), schemas.RATINGS)
    good = lines == ["1,2,3,4"]
    assert found.accepted.count() == good and found.rejected.count() == len(lines) - good
    assert found.counts["read"] == len(lines)


def test_files_are_read_once_and_rows_know_their_input(spark, scratch):
    paths = []
    for name, text in (("a", "1,10,4.5,1\n2,11\n"), ("b", "3,12,oops,1\n4,13,1.0,7\n")):
        paths.append(os.path.join(scratch, f"{name}.txt"))
        with open(paths[-1], "w") as f:
            f.write(text)
    found = read_ratings_checked(spark, paths, os.path.join(scratch, "out"))
    for p in paths:
        os.rename(p, p + ".gone")           # both outputs are written; the inputs are not needed again
    assert sorted((r.user_id, r.input) for r in found.accepted.collect()) == [(1, paths[0]), (4, paths[1])]
    assert sorted((r.line, r.reason, r.input) for r in found.rejected.collect()) == [
        ("2,11", "short", paths[0]), ("3,12,oops,1", "bad number", paths[1])]
    assert found.counts == {"read": 4, "accepted": 2, "short": 1, "bad number": 1}
