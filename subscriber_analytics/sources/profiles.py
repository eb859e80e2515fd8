"""Profile files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Options that choose files or end lines; they hold for the headers too.
_FILE_OPTIONS = ("pathGlobFilter", "recursiveFileLookup", "modifiedBefore", "modifiedAfter", "lineSep")


def headers(spark: SparkSession, path: str, **options) -> DataFrame:
    """(header, files): the first line with text of every file, and the files that begin with it.

    One pass of all files as lines: each file's first block is read by one task, which finds its first
    line, so only a line a file is shuffled. Empty files have none.
    """
    chosen = {name: value for name, value in options.items() if name in _FILE_OPTIONS}
    lines = spark.read.options(**chosen).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"))
    first = lines.where("start = 0 AND trim(value) <> ''").groupBy("file").agg(F.min_by("value", "place").alias("header"))
    return first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))


def _as_path(file: str) -> str:
    """A path that Spark names, as one it reads: not encoded as an address, without wildcards."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(file))


def read_profiles(spark: SparkSession, path: str, **options) -> DataFrame:
    """CSV with a header, UTF-8, every column as text.

    Columns are found by header name, in any order: one pass finds the header of every file, files with the
    same one are read together, and a column that a file lacks is NULL there. The number of jobs goes with the
    different headers, not with the files. Types are not inferred. Quotes inside quoted fields are doubled. Fields
    with line breaks need ``multiLine=True``, which makes a file one task; a header is one line even then.
    """
    chosen = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"', **options}
    together = headers(spark, path, **options).orderBy("header").collect()
    if len(together) < 2:
        return spark.read.options(**chosen).csv(path)
    parts = []
    for _, files in together:
        # The names come from the first file by the reader's own rules; the others are not looked at again.
        files = [_as_path(file) for file in files]
        names = spark.read.options(**chosen).csv(files[0]).schema
        parts.append(spark.read.options(**chosen).schema(names).csv(files))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def first_profiles(df: DataFrame, n: int | None, order: Sequence[str] = ()) -> DataFrame:
    """At most ``n`` rows; 0 or None is all of them. ``order`` makes the choice repeatable."""
    if not n:
        return df
    return df.orderBy(*[F.col(name) for name in order]).limit(n) if order else df.limit(n)
