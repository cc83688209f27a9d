"""Loading only what is new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from matchloom.operators.filters import first_seen
from matchloom.sources.batches import Batches
from matchloom.sources.tables import append_aligned, read_or_empty


def new_rows(candidates: DataFrame, existing: DataFrame, key: str, prune_by: str | None = None) -> DataFrame:
    """Candidates whose key is not there yet. Candidates without a key are left out: they could never
    be found again and would be added by every run.

    The existing table is reduced to the candidates' keys first: a few candidates are sent to
    the large table, which then needs no shuffle. `prune_by` names a partition column of the
    table that the key determines (such as the date of a match): only partitions between the
    candidates' first and last value are read. Finding these two values runs one job.
    """
    candidates = candidates.filter(F.col(key).isNotNull())
    if prune_by:
        first, last = candidates.agg(F.min(prune_by), F.max(prune_by)).first()
        existing = existing.filter(F.col(prune_by).isNull() | F.col(prune_by).between(first, last))
    known = existing.select(key).join(candidates.select(key), key, "left_semi")
    return candidates.join(known, key, "left_anti")


def incremental_append(
    candidates: DataFrame,
    path: str,
    key: str,
    order: Sequence[str],
    schema: T.StructType | None = None,
    partition_by: str | None = None,
) -> None:
    """Append the first row per new key to a Parquet table; a second run adds nothing. Rows without a key are not appended.

    Of several runs at once, the first to finish enters its batch; the others then drop the keys that came in
    and try again, so each key is there once. A run that breaks off adds all of its rows or none (`sources.batches`).
    `partition_by` must be determined by the key, see `new_rows`.
    """
    spark, schema = candidates.sparkSession, schema or candidates.schema
    folders = [partition_by] if partition_by else []
    batches = Batches(spark, path)
    last = batches.last()
    batches.finish(last)
    new_table = last == 0
    firsts = first_seen(candidates, [key], order).persist()
    try:
        stage = batches.new_stage()
        append_aligned(new_rows(firsts, read_or_empty(spark, path, schema), key, partition_by), stage, schema, folders)
    finally:
        firsts.unpersist()
    while True:
        staged = spark.read.schema(schema).parquet(stage)
        if staged.isEmpty() and not new_table:
            return batches.drop(stage)
        if batches.take(stage, last + 1):
            return None
        last, new_table = batches.last(), False
        batches.finish(last)
        rest, earlier = batches.new_stage(), stage
        append_aligned(new_rows(staged, read_or_empty(spark, path, schema), key, partition_by), rest, schema, folders)
        stage = rest
        batches.drop(earlier)


def start_incremental(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    order: Sequence[str],
    partition_by: str | None = None,
) -> StreamingQuery:
    """`incremental_append` for every batch of a file stream, over all files present now.

    A batch that is repeated after a failure finds its own rows in the table and adds none; a second
    stream into the same table at the same time adds no key twice.
    """
    schema = stream.schema

    def append(batch: DataFrame, _: int) -> None:
        incremental_append(batch, path, key, order, schema, partition_by)

    return (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
