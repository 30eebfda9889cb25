"""S6, S7 with nothing lost: lines that do not parse become a second output, with the reason.

The reference drops short lines silently and lets a bad number end the job. Here one pass over the input parses every
line, writes accepted and rejected lines side by side, and counts both while it writes.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from critiq import schemas
from critiq.functions.text import regex_literal
from critiq.session import shared_folder
from critiq.sources.ordered import as_paths, with_inputs
from critiq.sources.text import parse_delimited

SHORT, BAD = "short", "bad number"


@dataclass(frozen=True)
class CheckedLines:
    """accepted: the columns of the schema (and kept ones); rejected: line, reason, detail (and kept ones); counts by outcome."""

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def check_lines(lines: DataFrame, schema: T.StructType, sep: str = ",", line: str = "line",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """The fields of ``schema``, line, reason, detail (and ``keep``) of every text line.

    ``reason`` is NULL for a good line, ``short`` for one with fewer fields than the schema (``detail``: how many),
    ``bad number`` for one where a number is empty or does not parse (``detail``: the first such field and its text).
    Fields are trimmed; text fields are taken as they are, and what follows the last separator belongs to the last field. A
    NULL line is short.
    """
    size = F.coalesce(F.size(F.split(F.col(line), regex_literal(sep))), F.lit(0))
    size = F.when(F.col(line).isNull(), 0).otherwise(size)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = lines.select(F.struct(*parse_delimited(line, sep, texts)).alias("_raw"),
                       F.struct(*parse_delimited(line, sep, schema)).alias("_typed"), F.col(line).alias("_line"),
                       size.alias("_size"), *keep)
    bad = F.coalesce(*[
        F.when(F.col("_typed")[f.name].isNull(), F.concat(F.lit(f"{f.name}: "), F.col("_raw")[f.name]))
        for f in schema.fields if not isinstance(f.dataType, T.StringType)], F.lit(None))
    short = F.col("_size") < len(schema.fields)
    reason = F.when(short, SHORT).when(bad.isNotNull(), BAD)
    detail = F.when(short, F.concat(F.col("_size").cast("string"), F.lit(f" of {len(schema.fields)} fields"))).otherwise(bad)
    return raw.select("_typed.*", F.col("_line").alias("line"), reason.alias("reason"), detail.alias("detail"), *keep)


def split_lines(checked: DataFrame, folder: str, schema: T.StructType, keep: tuple[str, ...] = ()) -> CheckedLines:
    """Write the result of :func:`check_lines` once, accepted and rejected lines apart, and return both and their counts.

    One job reads the input, writes both outputs (folders ``accepted=true`` and ``accepted=false`` of a Parquet table)
    and counts them on the way; the frames returned read only their own folder.
    """
    seen = Observation()
    good = F.col("reason").isNull()
    counts = {"read": F.count(F.lit(1)), "accepted": F.count_if(good), SHORT: F.count_if(F.col("reason") == SHORT),
              BAD: F.count_if(F.col("reason") == BAD)}
    # an accepted line is not stored a second time as text
    rows = checked.observe(seen, *[c.alias(k) for k, c in counts.items()]).withColumn("accepted", good)
    rows.withColumn("line", F.when(~good, F.col("line"))).write.partitionBy("accepted").parquet(folder)
    table = checked.sparkSession.read.schema(checked.schema.add("accepted", "boolean")).parquet(folder)
    return CheckedLines(table.where("accepted").select(*schema.names, *keep),
                        table.where("not accepted").select("line", "reason", "detail", *keep), seen.get)


def read_ratings_checked(spark: SparkSession, paths: str | Iterable[str], folder: str | None = None, sep: str = ",",
                         input_name: str = "input") -> CheckedLines:
    """All rating files in one scan, split into accepted ratings and rejected lines, each with its input path."""
    paths = as_paths(paths)
    lines = with_inputs(spark.read.text(paths), paths, input_name)
    checked = check_lines(lines, schemas.RATINGS, sep, "value", (input_name,))
    return split_lines(checked, folder or shared_folder(spark, "ratings"), schemas.RATINGS, (input_name,))
