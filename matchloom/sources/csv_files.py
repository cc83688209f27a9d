"""Delimited text files.

Columns are read as text, or with the schema given; nothing is inferred from the data.
Spark drops a byte order mark and reads quoted fields as one. Files whose quoted fields may hold line
breaks are read with `line_breaks`, which cannot divide a file between tasks, or by `read_divided`, which can.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.dates import season_code
from matchloom.operators.columns import merge_headers, null_tokens, union_missing, unique_names
from matchloom.operators.series import Series, running_total, segment_records


def _reader(spark: SparkSession, header: bool, line_breaks: bool = False) -> DataFrameReader:
    return spark.read.option("header", header).option("quote", '"').option("escape", '"').option("multiLine", line_breaks)


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_typed(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, line_breaks: bool = False, malformed: str | None = None
) -> DataFrame:
    """File with a header line and known columns; a field that does not fit its type is null.

    `malformed` names a further column that shows a row as it is written where it does not fit the
    schema: a field of another type, too few fields or too many.
    """
    reader = _reader(spark, True, line_breaks).option("mode", "PERMISSIVE")
    if malformed:
        fields = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields
        schema = T.StructType([*fields, T.StructField(malformed, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    return reader.schema(schema).csv(path)


def read_text_columns(
    spark: SparkSession, path: str | Sequence[str], missing_tokens: bool = False, line_breaks: bool = False
) -> DataFrame:
    """File with a header line, every column as text. `missing_tokens` also turns texts like "NA" into nulls."""
    df = _reader(spark, True, line_breaks).csv(path)
    return null_tokens(df) if missing_tokens else df


def read_headerless(spark: SparkSession, path: str | Sequence[str], names: Sequence[str], line_breaks: bool = False) -> DataFrame:
    """File without a header line, every column as text under the given names."""
    return _reader(spark, False, line_breaks).schema(_text_schema(names)).csv(path)


def read_divided(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, header: bool = True, rows_per_task: int = 1_000_000
) -> DataFrame:
    """Files with known columns whose quoted fields may hold line breaks, each read by as many tasks as it has blocks.

    Lines are read as text. A line opens a record where the number of quotes before it in its file is even: counts
    are carried over blocks as one row per block (`operators.series`), so is the number of the record, and the lines of a
    record meet in a grouping by it. Quotes inside a field must be doubled, and an unquoted field must hold none.
    Line breaks inside quotes stay as they are written. Blank lines between records are skipped; an empty field is null, quoted or not,
    as is one that does not fit its type. With `header`, the first record of each
    file is left out. Files of more than `rows_per_task` lines are cut at their blocks.
    """
    at = ["_start", "_line"]
    lines = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"), F.col("value").alias("_text"),
    )
    lines = lines.withColumn("_quotes", F.length("_text") - F.length(F.replace("_text", F.lit('"'), F.lit(""))))
    series = Series(["_file"], at, [F.col("_start")], rows_per_task)
    counted = running_total(lines, series, F.col("_quotes").cast("bigint"), "_upto", lines)
    opens = (F.col("_upto") - F.col("_quotes")) % 2 == 0
    numbered = segment_records(counted, series, opens, "_record")
    whole = numbered.groupBy("_file", "_record").agg(F.array_sort(F.collect_list(F.struct(*at, "_text"))).alias("_lines"))
    # A carriage return at the end of a record is outside quotes and belongs to its line break.
    record = F.regexp_replace(F.array_join(F.col("_lines._text"), "\n"), "\r$|^\ufeff", "")
    records = whole.filter(F.col("_record") > 1) if header else whole
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    fields = F.from_csv("_csv", ddl, {"quote": '"', "escape": '"', "multiLine": "true"})
    return records.select(record.alias("_csv")).filter(F.col("_csv") != "").select(fields.alias("_row")).select("_row.*")


def _first_lines(spark: SparkSession, path: str, n: int) -> list[list[str]]:
    """The first lines of a file, split into fields. Only these lines come to the driver."""
    lines = [r.value for r in spark.read.text(path).head(n)]
    return list(csv.reader(lines))


def read_two_headers(spark: SparkSession, path: str) -> DataFrame:
    """File with two header lines, every column as text; the second line names a column unless it is blank there."""
    high, low = _first_lines(spark, path, 2)
    names = merge_headers(list(zip(high, low)))
    rows = read_headerless(spark, path, names)

    def is_line(fields: Sequence[str]):
        same = F.lit(True)
        for name, text in zip(names, fields):
            same = same & F.coalesce(F.col(f"`{name}`"), F.lit("")).eqNullSafe(F.lit(text))
        return same

    return rows.filter(~is_line(high) & ~is_line(low))


def _header_lines(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, str]]:
    """(file, first line) of each file, by name. Only these lines come to the driver."""
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.monotonically_increasing_id().alias("at"),
    )
    # Lines of one block are numbered in order, so the least number of a file's first block is its first line.
    first = lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "at").alias("line"))
    return sorted((unquote(r.path), r.line.removeprefix("\ufeff")) for r in first.collect())


def read_seasons(spark: SparkSession, paths: Sequence[str], season_pattern: str = r"(\d{4})(?=[^/]*$)") -> DataFrame:
    """One file per season, put together by column name, with the season's code taken from the file name.

    The header lines of all files are read in one job; files with the same header share one scan.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, line in _header_lines(spark, paths):
        header = tuple(unique_names([c.strip() for c in next(csv.reader([line]))]))
        groups.setdefault(header, []).append(path)
    season = season_code(F.regexp_extract(F.col("_metadata.file_path"), season_pattern, 1))
    frames = [
        _reader(spark, True).schema(_text_schema(header)).csv(same).select("*", season.alias("season"))
        for header, same in groups.items()
    ]
    return union_missing(frames)
