"""Batches that enter a Parquet table whole and one after the other.

A batch is written to a hidden folder of the table, then takes the next free number by renaming that folder. The
rename fails where another run took the number first; that run's batch must then be looked at before the next
try. A batch with a number counts as part of the table: its files are moved to their places right away, or by the
next run if this one breaks off. As a run takes number n + 1 only after the files of batch n are in place, no more than
the last batch can be unfinished. The file system must rename folders in one step, as HDFS does.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Hidden from Spark's readers by its first character.
FOLDER = "_batches"


class Batches:
    """The numbered batches of one table."""

    def __init__(self, spark: SparkSession, table: str):
        sc = spark.sparkContext
        self._hadoop = sc._jvm.org.apache.hadoop.fs
        self.table = self._hadoop.Path(table)
        self.folder = self._hadoop.Path(self.table, FOLDER)
        self._files = self._hadoop.FileContext.getFileContext(self.table.toUri(), sc._jsc.hadoopConfiguration())
        self._anyone = self._hadoop.permission.FsPermission.getDirDefault()
        # No options: never replace what is there.
        self._options = sc._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)

    def _exists(self, path) -> bool:
        return self._files.util().exists(path)

    def _rename(self, source, target) -> bool:
        """Whether this call moved the source; false if another run was first."""
        try:
            self._files.rename(source, target, self._options)
        except Py4JJavaError:
            if self._exists(target):
                return False
            raise
        return True

    def last(self) -> int:
        """Number of the last batch, 0 before the first."""
        if not self._exists(self.folder):
            return 0
        names = [s.getPath().getName() for s in self._files.util().listStatus(self.folder)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def new_stage(self) -> str:
        """A fresh hidden folder to write a batch to; a run that breaks off leaves it behind, unread."""
        return self._hadoop.Path(self.folder, f"stage-{uuid.uuid4().hex}").toString()

    def drop(self, stage: str) -> None:
        """Delete a batch that got no number."""
        self._files.delete(self._hadoop.Path(stage), True)

    def take(self, stage: str, number: int) -> bool:
        """Give a written batch its number, unless another batch has it; then put its files in place."""
        taken = self._rename(self._hadoop.Path(stage), self._hadoop.Path(self.folder, str(number)))
        if taken:
            self.finish(number)
        return taken

    def finish(self, number: int) -> None:
        """Move the files of a batch to their places in the table, those that are not there yet."""
        batch = self._hadoop.Path(self.folder, str(number))
        if self._exists(batch):
            self._move(batch, self.table)

    def _move(self, source, target) -> None:
        for found in self._files.util().listStatus(source):
            path = found.getPath()
            if path.getName().startswith(("_", ".")):
                continue
            place = self._hadoop.Path(target, path.getName())
            if found.isDirectory():
                self._files.mkdir(place, self._anyone, True)
                self._move(path, place)
            else:
                self._rename(path, place)
