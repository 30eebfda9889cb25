"""K1–K5: render result rows as text lines and write them.

Rendering is a projection (one ``line`` column), so it runs on the executors
and a write produces one file per partition; nothing passes through the
driver. Order is applied only by the caller (``orderBy`` before writing)
where the output is a report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from critiq.functions.format import pad_left, pad_right


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def render_key_value(df: DataFrame, key: Column | str, value: Column | str,
                     keep: Sequence[str] = ()) -> DataFrame:
    """K1: ``key<TAB>value`` lines (the key-value text output of a reduce step)."""
    return df.select(*keep, F.concat_ws("\t", _c(key).cast("string"), _c(value).cast("string")).alias("line"))


def render_delimited(df: DataFrame, cols: Sequence[Column | str], sep: str = "::",
                     keep: Sequence[str] = ()) -> DataFrame:
    """K3/K4: fields joined by ``sep`` (``::`` or ``,``); NULL fields render empty."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return df.select(*keep, F.concat_ws(sep, *parts).alias("line"))


def render_tsv(df: DataFrame, cols: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """K2 as a line: tab-joined fields, NULL as the empty field."""
    return render_delimited(df, list(cols or df.columns), "\t", keep)


def render_report_lines(df: DataFrame, fields: Sequence[tuple[Column | str, int, str]],
                        sep: str = " ", keep: Sequence[str] = ()) -> DataFrame:
    """K5: fixed-width report rows; ``fields`` are ``(column, width, "<" | ">")``.

    Fields are padded to at least ``width`` and never cut (a long title
    widens its row, like Python's format specs).
    """
    cells = [pad_right(c, w) if align == "<" else pad_left(c, w) for c, w, align in fields]
    return df.select(*keep, F.concat_ws(sep, *cells).alias("line"))


# Texts of the best-movie line and of its fallback when no movie qualifies.
BEST_LINE = "is the highest rated movie with an average rating of {avg} among movies with at least {k} ratings."
NO_BEST_KEY = "No movies exist"
NO_BEST_VALUE = "No movie with highest ratings"


def render_best_line(best: DataFrame, min_count: int, keep: Sequence[str] = ()) -> DataFrame:
    """K1 for the one-row result of ``best_movie``: ``title<TAB>sentence``, or the fallback line."""
    before, after = BEST_LINE.split("{avg}")
    after = after.replace("{k}", str(min_count))
    found = F.concat_ws("\t", F.col("title"), F.concat(F.lit(before), F.col("avg_rating").cast("string"), F.lit(after)))
    line = F.when(F.col("movie_id").isNotNull(), found).otherwise(F.lit(NO_BEST_KEY + "\t" + NO_BEST_VALUE))
    return best.select(*keep, line.alias("line"))


# Labels of the report's best-movie block, in order.
BEST_BLOCK = ["  Tên phim  : ", "  MovieID   : ", "  Avg Rating: ", "  Số lượt   : "]


def render_best_block(best: DataFrame) -> DataFrame:
    """K5: line_no, line of the best-movie block; no lines when no movie qualifies."""
    values = [F.col("title"), F.col("movie_id").cast("string"), F.format_string("%.4f", F.col("avg_rating")),
              F.col("n").cast("string")]
    lines = F.array(*[F.struct(F.lit(i + 1).alias("line_no"), F.concat(F.lit(label), v).alias("line"))
                      for i, (label, v) in enumerate(zip(BEST_BLOCK, values))])
    return best.where(F.col("movie_id").isNotNull()).select(F.inline(lines))


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a one-column ``line`` frame as text files (one per partition)."""
    lines.select("line").write.mode(mode).text(path)


MAX_ORDERED_FILES = 100_000  # names of more files would no longer sort in order


def write_ordered_lines(lines: DataFrame, path: str, order: Sequence[Column], files: int | None = None,
                        mode: str = "error") -> None:
    """The ``line`` column as text files that concatenate, by name, in the given order.

    Range partitions, each sorted and written as one file: the result is ordered over all files without a single
    task seeing all rows. ``order`` should be total (end in a unique key), otherwise ties come in any order and a
    value that many rows share makes one large file. ``files`` is by default ``spark.sql.shuffle.partitions``;
    empty ranges write no file. Read back with :func:`critiq.sources.read_numbered_lines`.
    """
    n = files or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not 0 < n <= MAX_ORDERED_FILES:
        raise ValueError(f"1 to {MAX_ORDERED_FILES} files, not {n}")
    ranged = lines.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged.select("line").write.mode(mode).option("compression", "none").text(path)


def write_report(body: DataFrame, key: Column | str, trailer: DataFrame, path: str, files: int | None = None,
                 mode: str = "error") -> None:
    """``line`` rows in the byte order of their key as text, then the lines of ``trailer``, in one ordered output.

    This is the output of a sorted reduce step that adds its closing line at the end. NULL keys come first, rows of equal keys by
    their line.
    """
    keyed = body.select(F.lit(0).alias("_part"), _c(key).cast("string").alias("_key"), "line")
    closing = trailer.select(F.lit(1).alias("_part"), F.lit(None).cast("string").alias("_key"), "line")
    write_ordered_lines(keyed.unionByName(closing), path, [F.col("_part"), F.col("_key").asc_nulls_first(), F.col("line")],
                        files, mode)


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: tab-separated lines, no header, no quoting; NULL as the empty field."""
    write_lines(render_tsv(df), path, mode)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """K4: comma-separated files without header.

    Fields holding the separator (titles with commas) are quoted, so the
    files read back with the same columns; NULL is the empty field.
    """
    (df.write.mode(mode).option("sep", sep).option("header", "false")
     .option("quote", '"').option("escape", '"').option("nullValue", "")
     .csv(path))
