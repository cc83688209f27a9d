"""Small tables given in the program."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def inline_table(spark: SparkSession, rows: Sequence[Sequence[object]], schema: str) -> DataFrame:
    """Constant rows as part of the plan: Spark knows their size and can broadcast them in a join."""
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    table = pa.Table.from_arrays([pa.array(list(c)) for c in columns], names=fields.names)
    return spark.createDataFrame(table, fields)
