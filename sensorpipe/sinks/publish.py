"""Replace folders of a partitioned table so that a failure at any moment loses no row.

New folders are written beside the old ones, in ``_next``, which readers pass over. Then the list of what is to be
swapped is stored, in one rename, and the folders are swapped one by one. ``recover`` finishes a swap whose list is
stored, and drops new folders without a list; so a table ends either as it was or as it was to be. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_NEXT, _SWAP = "_next", "_swap"


class _Table:
    """The files of one table, by names under its folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.fs = self._of("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _of(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._of(name))

    def names(self, folder: str = "") -> list[str]:
        """What readers see in a folder."""
        found = [s.getPath().getName() for s in self.fs.listStatus(self._of(folder))] if self.exists(folder) else []
        return sorted(n for n in found if n[0] not in "_.")

    def delete(self, name: str) -> None:
        if self.exists(name) and not self.fs.delete(self._of(name), True):
            raise OSError(f"cannot delete {name} of {self.path}")

    def move(self, name: str, to: str) -> None:
        if not self.fs.rename(self._of(name), self._of(to)):
            raise OSError(f"cannot move {name} of {self.path} to {to}")

    def note(self, gone: Sequence[str], coming: Sequence[str]) -> None:
        """Store the list of a swap; it is there as a whole or not at all."""
        out = self.fs.create(self._of(f"{_SWAP}.part"), True)
        out.write(bytearray(json.dumps({"gone": list(gone), "coming": list(coming)}).encode()))
        out.close()
        self.move(f"{_SWAP}.part", _SWAP)

    def noted(self) -> dict:
        stream = self.fs.open(self._of(_SWAP))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo what an earlier ``publish`` left; may itself be repeated."""
    table = _Table(spark, path)
    if table.exists(_SWAP):
        swap = table.noted()
        for name in swap["gone"]:
            table.delete(name)
        for name in swap["coming"]:
            # A folder that is no longer among the new ones has been swapped before.
            if table.exists(f"{_NEXT}/{name}"):
                table.delete(name)
                table.move(f"{_NEXT}/{name}", name)
        table.delete(_SWAP)
        spark.catalog.refreshByPath(path)
    for rest in (_NEXT, f"{_SWAP}.part"):
        table.delete(rest)


def publish(
    df: DataFrame, path: str, partition_by: Sequence[str], *, whole: bool = False, among: Sequence[str] = (), compression: str = "snappy"
) -> None:
    """Replace the partitions that occur in ``df``, which may read the table.

    Of the first partition column, folders named in ``among`` that get no rows are deleted; with ``whole`` all of the
    table that is not new is. Only names of folders are listed on the driver.
    """
    spark = df.sparkSession
    recover(spark, path)
    table = _Table(spark, path)
    rows = df.hint("rebalance", *partition_by)
    rows.write.option("compression", compression).partitionBy(*partition_by).parquet(f"{table.path}/{_NEXT}")
    coming = table.names(_NEXT)
    held = table.names()
    table.note([n for n in held if n not in coming and (whole or n in among)], coming)
    recover(spark, path)
