"""Many input paths read as one scan, with the input and the order of every line.

Spark packs files into tasks by size, so a scan's own row order says nothing about the order of the inputs. Every line
therefore carries its place: rank of the given path, file, start of the split, position in the split. All paths are
one scan; the rank comes by a join with one row per input file (a local table that Spark broadcasts after its size
check).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GLOB = {"*": "[^/]*", "?": "[^/]", "{": "(?:", "}": ")", ",": "|"}


def as_paths(paths: str | Iterable[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _plain(path: str) -> str:
    """A path without trailing slashes and with one way to write the local scheme."""
    return re.sub(r"^file:/+", "/", path).rstrip("/") or "/"


def _glob_regex(path: str) -> str:
    """The files that a path with wildcards names, or that lie below what it names."""
    out, braces, sets = "", 0, False
    for c in path:
        braces += (c == "{") - (c == "}")
        sets = c == "[" or sets and c != "]"
        literal = sets or c in "[]" or c == "," and not braces
        out += (c if c != "^" else r"\^") if literal and c != "," else GLOB.get(c, re.escape(c)) if not literal else ","
    return out


def path_ranks(files: Sequence[str], paths: Sequence[str]) -> list[int]:
    """Index into ``paths`` of the path that names every file (itself, a folder above it, or a wildcard); the last if several.

    ``files`` are URIs as Spark lists them. A path without scheme matches any scheme, a relative one any folder.
    """
    exact: dict[str, int] = {}
    patterns: list[tuple[int, re.Pattern]] = []
    for rank, path in enumerate(paths):
        plain = _plain(path)
        if plain.startswith("/") or "://" in plain:
            head, body = "", plain
        else:
            head, body = "(?:.*/)?", re.sub(r"^(\./)+", "", plain)
        if head or re.search(r"[*?\[{]", body):
            patterns.append((rank, re.compile(f"{head}{_glob_regex(body)}(?:/.*)?")))
        else:
            exact[plain] = rank
    ranks = []
    for file in files:
        whole = _plain(unquote(file))
        found = [-1]
        for form in {whole, re.sub(r"^\w+://[^/]*", "", whole)}:
            parts = form.split("/")
            found += [exact[head] for head in ("/".join(parts[:i]) or "/" for i in range(1, len(parts) + 1)) if head in exact]
            found += [rank for rank, pattern in patterns if pattern.fullmatch(form)]
        if max(found) < 0:
            raise ValueError(f"{file} belongs to none of the given paths")
        ranks.append(max(found))
    return ranks


def _file(col: Column) -> Column:
    return F.regexp_replace(col, "^file:/+", "file:/")


def with_inputs(scan: DataFrame, paths: str | Iterable[str], input_name: str | None = None,
                order_name: str | None = None) -> DataFrame:
    """``scan`` (one file scan of all ``paths``) with the path each row was read by and the order of its line.

    ``input_name`` holds the path as given. ``order_name`` is a struct that sorts by path, file, split and place; files
    below one path rank by name.
    """
    paths = as_paths(paths)
    files = sorted(set(scan.inputFiles()))
    ranks = path_ranks(files, paths)
    table = pa.table({"_file": pa.array([re.sub("^file:/+", "file:/", f) for f in files], pa.string()),
                      "_rank": pa.array(ranks, pa.int32()),
                      "_input": pa.array([paths[r] for r in ranks], pa.string())})
    known = scan.sparkSession.createDataFrame(table)
    placed = scan.select("*", _file(F.col("_metadata.file_path")).alias("_file"),
                         F.col("_metadata.file_block_start").alias("_start"),
                         F.monotonically_increasing_id().alias("_line"))
    out = placed.join(known, "_file")
    order = F.struct(F.col("_rank").alias("path"), F.col("_file").alias("file"), F.col("_start").alias("start"),
                     F.col("_line").alias("line"))
    return out.select(*scan.columns, *([F.col("_input").alias(input_name)] if input_name else []),
                      *([order.alias(order_name)] if order_name else []))


def read_with_inputs(spark: SparkSession, paths: str | Iterable[str], read: Callable, input_name: str | None = None,
                     order_name: str | None = None) -> DataFrame:
    """``read(reader, paths)`` over all paths at once (see :func:`with_inputs`)."""
    paths = as_paths(paths)
    return with_inputs(read(spark.read, paths), paths, input_name, order_name)


def number_lines(lines: DataFrame, order: str = "line_no") -> DataFrame:
    """Turn the order of :func:`with_inputs` into line numbers 1..n over all inputs.

    The sizes of the splits (one row each) are summed up in order, broadcast, and added to the place within the split.
    """
    split = [F.col(f"{order}.{c}").alias(f"_{c}") for c in ("path", "file", "start")]
    keyed = lines.select("*", *split, F.col(f"{order}.line").alias("_line"))
    keys = ["_path", "_file", "_start"]
    sizes = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"), F.min("_line").alias("_first"))
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_line") - F.col("_first") + 1
    rest = [c for c in lines.columns if c != order]
    return keyed.join(F.broadcast(sizes), keys).select(number.alias(order), *rest)


def read_numbered_lines(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """line_no, line of text files: 1..n in the order of the paths, the files below them by name, and their lines."""
    lines = read_with_inputs(spark, paths, lambda reader, p: reader.text(p), order_name="line_no")
    return number_lines(lines.select("line_no", F.col("value").alias("line")))
