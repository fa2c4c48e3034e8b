"""Folders of micro-batches: commit marks, recovery and compaction, in any store that Spark writes to."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

BATCH = "batch_id"
# Readers pass over names that begin with an underscore.
STAGED, COMMITTED, COMPACTED = "_staged", "_committed", "_compacted"


class Folder:
    """A folder of a Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(name)))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def mark(self, name: str) -> None:
        """An empty file, its folders made with it."""
        self._fs.create(self._path(name), True).close()

    def rename(self, name: str, to: str) -> None:
        self._fs.mkdirs(self._path(to).getParent())
        if not self._fs.rename(self._path(name), self._path(to)):
            raise OSError(f"{self.path}: {name} could not be renamed to {to}")


def batches(folder: Folder) -> list[int]:
    """Numbers of the batches that readers of the folder see."""
    found = [re.fullmatch(rf"{BATCH}=(\d+)", n) for n in folder.names()]
    return sorted(int(m[1]) for m in found if m)


def recover(spark: SparkSession, path: str) -> None:
    """End a compaction that stopped half way: a whole one takes its place, a partial one goes."""
    folder = Folder(spark, path)
    for name in folder.names(COMPACTED):
        first, last = map(int, name.split("-"))
        if folder.exists(f"{COMPACTED}/{name}/_SUCCESS"):
            _put_in_place(folder, name, first, last)
        else:
            folder.delete(f"{COMPACTED}/{name}")


def _put_in_place(folder: Folder, name: str, first: int, last: int) -> None:
    for n in batches(folder):
        if first <= n <= last:
            folder.delete(f"{BATCH}={n}")
    folder.rename(f"{COMPACTED}/{name}", f"{BATCH}={last}")


def compact(spark: SparkSession, path: str, fmt: str = "orc", keep_last: int = 1) -> int:
    """Put the rows of many small batch folders into one folder with few files; returns how many folders it took.

    The last ``keep_last`` batches stay as they are, because a stream may run
    its last batch again. The rows of all others get the number of the last of
    them. File sizes follow the measured bytes. The new folder is written out of
    the readers' sight and takes the old ones' place when it is whole; a run
    that was stopped is ended by the next one, or by the next batch. One writer
    per folder is assumed; between the last two steps readers miss the rows.
    """
    recover(spark, path)
    folder = Folder(spark, path)
    old = batches(folder)
    old = old[: len(old) - keep_last] if keep_last else old
    if len(old) < 2:
        return 0
    rows = spark.read.format(fmt).load([f"{folder.path}/{BATCH}={n}" for n in old])
    name = f"{old[0]}-{old[-1]}"
    rows.hint("rebalance").write.format(fmt).save(f"{folder.path}/{COMPACTED}/{name}")
    _put_in_place(folder, name, old[0], old[-1])
    return len(old)
