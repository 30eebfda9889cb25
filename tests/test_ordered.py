"""Ordered text output, line order over many files, and positions of sorted rows."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from critiq import schemas
from critiq.operators import argmax_with_ties, dedupe_dimension, sort_desc_tiebreak, with_position
from critiq.sinks import write_ordered_lines, write_report
from critiq.sources import read_dimension, read_movies, read_numbered_lines, read_ratings
from critiq.sources.ordered import path_ranks
from tests.conftest import explain_text


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def _concatenated(folder):
    return [line for name in sorted(glob.glob(f"{folder}/part-*")) for line in open(name, encoding="utf-8").read().splitlines()]


@pytest.mark.parametrize("files", [1, 7, 40])
def test_files_concatenate_in_order(spark, scratch, files):
    rnd = random.Random(files)
    rows = [(rnd.choice(["5", "10", "é", "Z", "a", "zz", "10 "]) + str(rnd.randrange(50)), f"line {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, line string").repartition(6)
    out = os.path.join(scratch, "out")
    write_ordered_lines(df, out, [F.col("k"), F.col("line").desc()], files)
    want = [line for k, line in sorted(sorted(rows, key=lambda r: r[1], reverse=True), key=lambda r: r[0].encode())]
    assert _concatenated(out) == want
    assert len(glob.glob(f"{out}/part-*")) <= files
    got = read_numbered_lines(spark, out)
    assert got.columns == ["line_no", "line"]
    assert [tuple(r) for r in got.orderBy("line_no").collect()] == list(enumerate(want, 1))


def test_report_keys_are_ordered_as_text_and_the_trailer_is_last(spark, scratch):
    body = spark.createDataFrame([(10, "ten"), (9, "nine"), (None, "none"), (100, "hundred"), (9, "again")],
                                 "id long, line string")
    out = os.path.join(scratch, "out")
    write_report(body, "id", spark.createDataFrame([("the best",)], "line string"), out, files=4)
    assert _concatenated(out) == ["none", "ten", "hundred", "again", "nine", "the best"]
    with pytest.raises(Exception, match="already exists"):
        write_report(body, "id", body, out)
    with pytest.raises(ValueError):
        write_ordered_lines(body, out + "2", [F.col("id")], files=100_001)


def test_empty_output_reads_back_empty(spark, scratch):
    out = os.path.join(scratch, "out")
    write_ordered_lines(spark.createDataFrame([], "line string"), out, [F.col("line")], 3)
    assert read_numbered_lines(spark, out).collect() == []


def test_line_numbers_over_splits_of_large_files(spark, scratch):
    paths = [_write(os.path.join(scratch, f"{name}.txt"), [f"{name} {i} " + "x" * (i % 90) for i in range(n)])
             for name, n in (("b", 4000), ("a", 1), ("c", 2500))]
    want = [line for p in paths for line in open(p, encoding="utf-8").read().splitlines()]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = read_numbered_lines(spark, paths)
        assert [tuple(r) for r in got.orderBy("line_no").collect()] == list(enumerate(want, 1))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_path_ranks():
    files = ["file:///data/in/a%20b.txt", "file:/data/in/sub/c.txt", "file:///data/part-7,x/d%25.txt"]
    assert path_ranks(files, ["/data/in", "file:/data/part-7,x"]) == [0, 0, 1]
    assert path_ranks(files, ["/data/part-?,x/*", "/data/in/sub/", "/data/in/a b.txt"]) == [2, 1, 0]
    assert path_ranks(files, ["in", "./data/*"]) == [1, 1, 1]
    assert path_ranks(files[:1], ["/data/{in,out}/a[ _]b.*"]) == [0]
    assert path_ranks(["hdfs://n/u/x/r.txt"], ["/u", "hdfs://n/u/x"]) == [1]
    with pytest.raises(ValueError, match="none of the given paths"):
        path_ranks(files, ["/data/inn", "/data/part-7"])


def test_a_thousand_paths_are_one_scan_and_the_last_line_wins(spark, scratch):
    rnd = random.Random(4)
    names = [f"f{i:04d}.txt" for i in range(1000)]
    rnd.shuffle(names)
    want, paths = {}, []
    for name in names:
        lines = [f"{rnd.randrange(60)}, {rnd.choice('MF')}, {rnd.randrange(90)}, {i}, {name}" for i in range(3)]
        paths.append(_write(os.path.join(scratch, name), lines))
        want.update({line.split(",")[0]: tuple(line.split(", ")) for line in lines})
    users = read_dimension(spark, paths, schemas.USERS, line_order=True)
    plan = explain_text(users, "simple")
    assert plan.count("FileScan") == 1 and "Union" not in plan
    last = dedupe_dimension(users, "user_id", "line_no").drop("line_no")
    assert sorted(tuple(map(str, r)) for r in last.collect()) == sorted(want.values())


def test_rows_know_their_input(spark, scratch):
    one = _write(os.path.join(scratch, "one", "r 1.txt"), ["1,10,4.5,1", "2,11,3.0,2"])
    two = os.path.dirname(_write(os.path.join(scratch, "two", "x.txt"), ["1,10,4.5,1"]))
    _write(os.path.join(two, "y.txt"), ["3,12,1.0,5"])
    for strict in (False, True):
        df = read_ratings(spark, [one, two], strict=strict, input_name="input")
        assert explain_text(df, "simple").count("FileScan") == 1
        assert sorted((r.input, r.user_id) for r in df.collect()) == sorted([(one, 1), (one, 2), (two, 1), (two, 3)])
    movies = read_movies(spark, [_write(os.path.join(scratch, "m.txt"), ["1,A,X", "1,B,Y"])], line_order=True)
    assert dedupe_dimension(movies, "movie_id", "line_no").collect()[0].title == "B"


def test_positions_prove_an_order(spark):
    rnd = random.Random(8)
    rows = [(k, rnd.choice([None, 1, 2, 5])) for k in range(5000)]
    df = spark.createDataFrame(rows, "k long, m long").repartition(9)
    got = with_position(sort_desc_tiebreak(df, "m", "k"))
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert sorted((r.position, r.k, r.m) for r in got.collect()) == [(i + 1, *r) for i, r in enumerate(want)]
    assert with_position(df.where("k < 0")).collect() == []


def test_many_ties_stay_spread(spark):
    n = 1_000_000
    df = spark.range(n, numPartitions=8).select(F.col("id").alias("k"), F.lit(7).alias("c")).unionByName(
        spark.createDataFrame([(-1, 3), (-2, None)], "k long, c int"))
    top = argmax_with_ties(df, "c")
    assert "Window" not in explain_text(top, "simple")
    sizes = [r["count"] for r in top.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n and max(sizes) <= n // 4
    assert argmax_with_ties(df.where("c is null"), "c").collect() == []
    assert argmax_with_ties(df.limit(0), "c").collect() == []
