"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the library is written for. They only confirm how joins and shuffles
#: should be planned; results do not depend on them (except the time zone).
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Rows of a stored file at least, and files that are few whatever the rows.
FILE_ROWS, FEW_FILES = 20_000, 8

#: On a cluster adaptive execution starts from many shuffle partitions and merges the small ones;
#: it cannot make more than it starts with.
CLUSTER_CONF = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000"}


def build_session(app: str = "matchloom", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session with the recommended settings; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = str(master or os.environ.get("MASTER", "")).startswith("local")
    for key, value in {**RECOMMENDED_CONF, **({} if local else CLUSTER_CONF), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    It lies below `spark.checkpoint.dir`. Only a local-mode session without that
    setting gets a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/matchloom/{purpose}-{uuid.uuid4().hex}"


def in_few_files(df: DataFrame, rows: int | None) -> DataFrame:
    """A frame of at most so many short rows, to be stored; its last stage has no more tasks than they need.

    A small frame else gets a file from each shuffle partition where adaptive execution doesn't merge these,
    and on a local file system an executor starts a process for the permissions of each file and of its checksums.
    """
    return df if rows is None else df.coalesce(max(FEW_FILES, -(-rows // FILE_ROWS)))


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back from there.

    For results that a later plan uses several times: they are computed once, and a lost
    executor costs no more than the files it was reading.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
