"""Text readers and writers on hand-made files."""

import os

import pytest
from pyspark.sql import types as T

from critiq import schemas
from critiq.sinks import render_tsv, write_lines, write_tsv
from critiq.sources import (
    filter_required_fields, parse_delimited, read_dimension, read_movies, read_ratings, read_reviews,
    read_tokens, read_wordlist,
)


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines))
    return path


def test_ratings_two_files_spaces_short_row_bad_number(spark, scratch):
    p1 = _write(os.path.join(scratch, "r1.txt"), ["1, 10, 4.5, 1577836800", " 2 ,10,3.0,1577836801", "3, 11"])
    p2 = _write(os.path.join(scratch, "r2.txt"), ["1, 11, oops, 1577836802", "4, 12, 2.0, 1577836803", ""])
    df = read_ratings(spark, [p1, p2])
    rows = sorted(tuple(r) for r in df.collect())
    assert len(rows) == 5          # blank line skipped, both files unioned
    assert (2, 10, 3.0, 1577836801) in rows
    assert (3, 11, None, None) in rows          # short row padded
    assert (1, 11, None, 1577836802) in rows    # bad number -> NULL (permissive)
    kept = filter_required_fields(df, ["user_id", "movie_id", "rating"]).count()
    assert kept == 3


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_ratings_drop_short_lines_and_fail_on_bad_numbers(spark, scratch, ansi):
    good = _write(os.path.join(scratch, "good.txt"), ["1,10,4.5,1", "\t2 ,\t11,3.0 , 2\t", "3,12"])
    bad = _write(os.path.join(scratch, "bad.txt"), ["1,10,4.5,1", "1,11,x,2"])
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = sorted(tuple(r) for r in read_ratings(spark, good, strict=True).collect())
        assert rows == [(1, 10, 4.5, 1), (2, 11, 3.0, 2)]
        with pytest.raises(Exception, match="not a double: x"):
            read_ratings(spark, [good, bad], strict=True).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_movies_title_with_comma_and_single_genre(spark, scratch):
    p = _write(os.path.join(scratch, "m.txt"), [
        "31, Paper Lantern (2011), Family|Fantasy",
        "7,Slow River, Quiet Field (2004),Action",
        "9,  Solo  ,Drama  ",
        "bad line without commas",
    ])
    got = {r.movie_id: (r.title, r.genres) for r in read_movies(spark, p).collect()}
    assert got == {31: ("Paper Lantern (2011)", "Family|Fantasy"),
                   7: ("Slow River, Quiet Field (2004)", "Action"),
                   9: ("Solo", "Drama")}


def test_dimension_reader_users(spark, scratch):
    p = _write(os.path.join(scratch, "u.txt"), ["1, M, 35, 4, 02139", "2,F,50,7,10001"])
    rows = sorted(tuple(r) for r in read_dimension(spark, p, schemas.USERS).collect())
    assert rows == [(1, "M", 35, 4, "02139"), (2, "F", 50, 7, "10001")]


def test_reviews_semicolon_empty_field_is_null(spark, scratch):
    p = _write(os.path.join(scratch, "rev.csv"), ['1;Phòng "đẹp", sạch;ROOMS;QUALITY;positive',
                                                  ";no id here;GENERAL;;negative",
                                                  "3;;PRICES;VALUE;"])
    rows = {r.review: r for r in read_reviews(spark, p).collect()}
    assert rows['Phòng "đẹp", sạch'].topic == "ROOMS"       # quotes kept, no quoting
    assert rows["no id here"].id is None and rows["no id here"].aspect is None
    assert rows[None].sentiment is None


def test_wordlist_trims_and_skips_blank(spark, scratch):
    p = _write(os.path.join(scratch, "sw.txt"), ["và ", "", "của", "và", "bởi vì"])
    assert sorted(r.word for r in read_wordlist(spark, p).collect()) == ["bởi vì", "của", "và", "và"]


def test_tokens_roundtrip_tab_separated(spark, scratch):
    df = spark.createDataFrame([("phòng", "ROOMS", "QUALITY", "positive"), ("giá", "PRICES", "VALUE", None)],
                               schemas.TOKENS)
    out = os.path.join(scratch, "tok")
    write_tsv(df, out)
    back = sorted(tuple(r) for r in read_tokens(spark, out).collect())
    assert back == sorted(tuple(r) for r in df.collect())


def test_parse_delimited_strict_and_lenient(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                           T.StructField("c", T.DoubleType())])
    lines = spark.createDataFrame([(" 1 , x , 2.5",), ("2,y",), ("z,w,1,extra",)], "line string")
    got = [tuple(r) for r in lines.select(*parse_delimited("line", ",", schema)).collect()]
    assert got == [(1, "x", 2.5), (2, "y", None), (None, "w", None)]   # at most 3 parts: "1,extra" is one field
    with pytest.raises(Exception):
        lines.select(*parse_delimited("line", ",", schema, strict=True)).collect()


def test_write_lines_and_render_tsv(spark, scratch):
    df = spark.createDataFrame([("a", None), ("b", "c")], "x string, y string")
    out = os.path.join(scratch, "lines")
    write_lines(render_tsv(df), out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["a\t", "b\tc"]


def test_duplicate_dimension_key_last_line_wins(spark, scratch):
    from critiq.operators import dedupe_dimension

    p = _write(os.path.join(scratch, "dup.txt"), ["1,Old Title,Drama", "2,Other,Comedy", "1,New Title,Drama|War"])
    movies = dedupe_dimension(read_movies(spark, p, line_order=True), "movie_id", "line_no")
    got = {r.movie_id: (r.title, r.genres) for r in movies.collect()}
    assert got == {1: ("New Title", "Drama|War"), 2: ("Other", "Comedy")}
    users = dedupe_dimension(read_dimension(spark, _write(os.path.join(scratch, "u.txt"), ["7,M,30,1,x", "7,F,31,2,y"]),
                                            schemas.USERS, line_order=True), "user_id", "line_no")
    assert [(r.user_id, r.gender) for r in users.collect()] == [(7, "F")]


def test_last_line_wins_over_files_in_the_given_order(spark, scratch):
    from critiq.operators import dedupe_dimension

    # the later file is the larger one, then the smaller one: the scan's own order must not matter
    small = _write(os.path.join(scratch, "b_small.txt"), ["1,Small,Drama", "2,Kept,Drama"])
    large = _write(os.path.join(scratch, "a_large.txt"), ["1,Large,Drama"] + [f"{i},Filler {i},Comedy"
                                                                            for i in range(100, 4000)])
    for paths, title in (([small, large], "Large"), ([large, small], "Small")):
        movies = dedupe_dimension(read_movies(spark, paths, line_order=True), "movie_id", "line_no")
        got = {r.movie_id: r.title for r in movies.where("movie_id < 100").collect()}
        assert got == {1: title, 2: "Kept"}


def test_dedupe_ties_are_decided_by_the_other_columns(spark):
    from critiq.operators import dedupe_dimension

    rows = [(1, 5, "b"), (1, 5, "c"), (1, 4, "z"), (2, 1, None), (2, 1, "a")]
    got = dedupe_dimension(spark.createDataFrame(rows, "k int, o int, v string"), "k", "o")
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "c"), (2, "a")]
