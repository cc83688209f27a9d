"""Writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from matchloom.operators.columns import align_to_schema


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a folder by CSV files with a header line."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table. Never the table that is read: write a cleaned table to a path of its own."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or no rows of the schema before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_aligned(df: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Append rows to a Parquet table in the table's schema: missing columns null, others left out."""
    align_to_schema(df, schema).write.mode("append").partitionBy(*partition_by).parquet(path)
