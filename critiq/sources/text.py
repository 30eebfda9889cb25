"""Delimited-text ingestion.

All readers take an explicit schema and never infer one. The
inputs are UTF-8 text without header or quoting, so quoting is switched off
(``quote=""``) and fields are whitespace-trimmed, which covers both the
``", "`` and the ``","`` separated variants.

A number that does not parse is NULL by default (then
:func:`filter_required_fields` drops its row, S6). With ``strict`` short
lines are dropped and a bad number fails the query, whatever the session's
ANSI setting (S7).

The parser options of each input kind are shared with :func:`parse_lines`,
which applies them to lines that are already a column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from critiq import schemas
from critiq.functions.text import regex_literal, strip
from critiq.sources.ordered import as_paths, read_with_inputs, with_inputs


def csv_options(sep: str, trimmed: bool = True) -> dict[str, str]:
    """Parser options of a delimited input: no header, no quoting; ``trimmed`` drops blanks around fields."""
    return {"sep": sep, "header": "false", "quote": "", "escape": "",
            "ignoreLeadingWhiteSpace": str(trimmed).lower(), "ignoreTrailingWhiteSpace": str(trimmed).lower(),
            "mode": "PERMISSIVE"}


REVIEW_OPTIONS = csv_options(";", trimmed=False)
TOKEN_OPTIONS = csv_options("\t", trimmed=False)


def parse_lines(lines: DataFrame, schema: T.StructType, options: dict[str, str], line: str = "line") -> DataFrame:
    """The columns of ``schema`` from a text column, parsed as the file readers do."""
    parsed = F.from_csv(F.col(line), schema.simpleString()[len("struct<"):-1].replace(":", " "), options)
    return lines.select(parsed.alias("_row")).select("_row.*")


def read_ratings(spark: SparkSession, paths: str | Iterable[str], sep: str = ",", strict: bool = False,
                 input_name: str | None = None) -> DataFrame:
    """Several rating files read as one relation (bag union, duplicates kept), in one scan.

    ``strict`` drops lines with fewer fields than the schema (S6) and fails
    on a bad number (S7). ``input_name`` adds a column of that name with the
    path, as given, that a row was read by. To keep bad lines instead, with
    the reason, see :mod:`critiq.sources.checked`.
    """
    paths = as_paths(paths)
    scan = (spark.read.text(paths) if strict
            else spark.read.schema(schemas.RATINGS).options(**csv_options(sep)).csv(paths))
    if input_name:
        scan = with_inputs(scan, paths, input_name)
    return parse_ratings(scan, "value", sep, [input_name] if input_name else []) if strict else scan


def parse_ratings(lines: DataFrame, line: str = "line", sep: str = ",", keep: Sequence[str] = ()) -> DataFrame:
    """S6 and S7 together: lines with too few fields go, a bad number fails the query."""
    enough = F.size(F.split(F.col(line), regex_literal(sep))) >= len(schemas.RATINGS.fields)
    return lines.where(enough).select(*parse_delimited(line, sep, schemas.RATINGS, strict=True), *keep)


def read_dimension(spark: SparkSession, paths: str | Iterable[str], schema: T.StructType,
                   sep: str = ",", line_order: bool = False) -> DataFrame:
    """Comma-delimited dimension (users, occupation), whitespace tolerant.

    ``line_order`` adds ``line_no``, which grows with the place of a line in
    the input; ``dedupe_dimension(dim, key, "line_no")`` then keeps the last
    line of each key, as a hash map filled line by line does (J9).
    """
    paths = as_paths(paths)
    scan = spark.read.schema(schema).options(**csv_options(sep)).csv(paths)
    return with_inputs(scan, paths, order_name="line_no") if line_order else scan


def parse_movies(lines: DataFrame, line: str = "line", strict: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """movie_id, title, genres of text lines: first field = id, last field = genres, everything between = title.

    A plain split on ``,`` would cut titles that hold commas (D14), so the
    fields in between are joined back. Lines with fewer than three fields are
    dropped; a non-numeric id is NULL and dropped (or fails with ``strict``).
    """
    parts = F.split(F.col(line), ",")
    n = F.size(parts)
    movie_id = _typed(strip(F.get(parts, 0)), T.LongType(), strict)
    title = strip(F.array_join(F.slice(parts, F.lit(2), n - 2), ","))
    return (lines.where(n >= 3)
            .select(movie_id.alias("movie_id"), title.alias("title"), strip(F.element_at(parts, -1)).alias("genres"),
                    *keep)
            .where(F.col("movie_id").isNotNull()))


def read_movies(spark: SparkSession, paths: str | Iterable[str], strict: bool = False,
                line_order: bool = False) -> DataFrame:
    """S2 for movies (see :func:`parse_movies`); ``line_order`` as in :func:`read_dimension`."""
    if line_order:
        lines = read_with_inputs(spark, paths, lambda reader, p: reader.text(p), order_name="line_no")
        return parse_movies(lines, "value", strict, ["line_no"])
    return parse_movies(spark.read.text(as_paths(paths)), "value", strict)


def read_reviews(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """S3: ``;`` separated reviews, every column a string; empty field -> NULL."""
    return spark.read.schema(schemas.REVIEWS).options(**REVIEW_OPTIONS).csv(as_paths(paths))


def parse_words(lines: DataFrame, line: str = "line") -> DataFrame:
    """word: one per line; trimmed, blank lines skipped.

    Duplicates are kept: the anti join that consumes the list ignores them
    (D12), and de-duplicating would cost a shuffle.
    """
    return lines.select(strip(F.col(line)).alias("word")).where(F.col("word") != "")


def read_wordlist(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """One word per line (see :func:`parse_words`)."""
    return parse_words(spark.read.text(as_paths(paths)), "value")


def read_tokens(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Tab separated re-load of stored tokens (word, topic, aspect, sentiment)."""
    return spark.read.schema(schemas.TOKENS).options(**TOKEN_OPTIONS).csv(as_paths(paths))


def union_inputs(*frames: DataFrame) -> DataFrame:
    """S1 for frames already loaded: UNION ALL by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def filter_required_fields(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Drop rows that miss any required field (short or unparsable lines)."""
    cond = None
    for c in required:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond)


def parse_delimited(line: Column | str, sep: str, schema: T.StructType,
                    strict: bool = False) -> list[Column]:
    """split a text line into typed, trimmed fields.

    The line is split into at most ``len(schema)`` parts (like Python's
    ``split(sep, n-1)``), each part is trimmed and cast to the schema type.
    A value that does not parse is NULL, or with ``strict`` fails the query
    whatever the session's ANSI setting (S7).
    """
    col = F.col(line) if isinstance(line, str) else line
    parts = F.split(col, regex_literal(sep), len(schema.fields))
    return [_typed(strip(F.get(parts, i)), field.dataType, strict).alias(field.name)
            for i, field in enumerate(schema.fields)]


def _typed(raw: Column, kind: T.DataType, strict: bool) -> Column:
    """``raw`` as ``kind``; a text that does not parse is NULL, or an error with ``strict``."""
    if isinstance(kind, T.StringType):
        return raw
    value = raw.try_cast(kind)
    if not strict:
        return value
    bad = F.raise_error(F.concat(F.lit(f"not a {kind.simpleString()}: "), raw)).cast(kind)
    return F.when(raw.isNotNull() & value.isNull(), bad).otherwise(value)
