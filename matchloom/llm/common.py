"""Helpers shared by the text operators."""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows handled at once inside a task. Texts may be long, so that a task holds few of them.
ROWS_AT_ONCE = 512


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the corpus, as it lies in its folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keyed_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only key and text under fixed names, a null text being empty; other columns cannot clash."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[list, list], Iterable[tuple]]]) -> DataFrame:
    """Turn the two columns of a frame into rows of `schema`, in Arrow batches.

    `make` is called once for each task and returns a function from a list of keys and a list of
    texts to output tuples. Nothing is kept between batches but what that function holds.
    """
    target = to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                rows = list(work(part.column(0).to_pylist(), part.column(1).to_pylist()))
                columns = list(zip(*rows, strict=True)) or [()] * len(target)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return df.mapInArrow(run, schema)


ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}


def to_arrow(schema: str) -> pa.Schema:
    """The Arrow form of a DDL schema of plain columns and lists of them; needs no session."""
    fields = []
    for column in schema.split(","):
        name, kind = column.split()
        inner = kind.removeprefix("array<").removesuffix(">")
        fields.append(pa.field(name, pa.list_(ARROW[inner]) if inner != kind else ARROW[kind]))
    return pa.schema(fields)


def with_column(df: DataFrame, text: str, name: str, kind: str, make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """All columns of a frame plus one computed from the text of each row, in Arrow batches."""
    extra = to_arrow(f"{name} {kind}").field(0)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T._parse_datatype_string(kind))])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                found = work([t or "" for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, extra.type)], names=[*part.schema.names, name])

    return df.mapInArrow(run, schema)


#: Columns of documents that stages read by name.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def keeps_columns(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage on documents, shielded from other columns whose names clash with its own or each other.

    Inside the stage these bear neutral names; the result has all columns of the input, in their order.
    """

    @wraps(stage)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        names = [c if c in OWN and c not in docs.columns[:i] else f"user_{i}" for i, c in enumerate(docs.columns)]
        return stage(docs.toDF(*names), *args, **options).select(*names).toDF(*docs.columns)

    return run


class Spans:
    """Which stretches of a text are taken by spans (kind, start, end)."""

    def __init__(self, spans: Iterable[tuple[str, int, int]]) -> None:
        taken = sorted((s, e) for _, s, e in spans)
        self.starts = [s for s, _ in taken]
        self.ends = list(accumulate((e for _, e in taken), max))

    def meet(self, start: int, end: int) -> bool:
        """Whether any span reaches into the stretch."""
        before = bisect_left(self.starts, end)
        return before > 0 and self.ends[before - 1] > start


def span_text(spans: Iterable[tuple[str, int, int]], order: list[str]) -> str:
    """Spans as kind:start:end, by start, then by the place of the kind in `order`."""
    rank = {k: i for i, k in enumerate(order)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], rank[x[0]], x[2])))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def ids_bytes(ids: Iterable[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    ids = list(ids)
    return struct.pack(f"<{len(ids)}I", *ids)
