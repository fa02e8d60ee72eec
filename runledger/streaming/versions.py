"""Versioned stream sinks (ST-04): micro-batches written as versions, folded into one base version.

``<path>/batch_id=N`` holds what micro-batch N changed, ``<path>-base/upto=M`` the merged rows of all
batches up to M. A base counts once its ``_SUCCESS`` marker is there; readers take the newest one and the
batches after it, so what a read costs follows the keys and not the number of batches ever written.

Every step may be repeated: a replayed batch overwrites its own folder, and one at or below the base is
ignored; an unfinished fold has no marker and is overwritten by the next one. Files that a fold has
replaced stay until the fold after it, for readers that began before.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.operators.runs import latest


class Versions:
    """The rows of a sink that replace each other by key.

    ``order_cols`` decide which row of a key wins (greatest); without them the later batch wins. Rows
    are folded into a new base after every ``fold_every`` batches (0: only when :meth:`fold` is called).
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order_cols: Sequence[str] = (),
                 fold_every: int = 16):
        self.spark, self.path, self.base = spark, path.rstrip("/"), path.rstrip("/") + "-base"
        self.keys, self.order, self.fold_every = list(keys), [*order_cols, "batch_id"], fold_every

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbered(self, root: str, name: str) -> list[int]:
        p, fs = self._fs(root)
        if not fs.exists(p):
            return []
        found = (re.fullmatch(name + r"=(\d+)", s.getPath().getName()) for s in fs.listStatus(p))
        return sorted(int(m[1]) for m in found if m)

    def bases(self) -> list[int]:
        """The batches up to which complete bases reach, ascending."""
        done = []
        for m in self._numbered(self.base, "upto"):
            p, fs = self._fs(f"{self.base}/upto={m}/_SUCCESS")
            if fs.exists(p):
                done.append(m)
        return done

    def batches(self) -> list[int]:
        """The batches after the newest base, ascending."""
        at = max(self.bases(), default=-1)
        return [b for b in self._numbered(self.path, "batch_id") if b > at]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Write a micro-batch as its version; fold when it is due."""
        batch.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        if self.fold_every and (batch_id + 1) % self.fold_every == 0:
            self.fold()

    def _rows(self) -> DataFrame | None:
        parts = []
        at = max(self.bases(), default=-1)
        if at >= 0:
            parts.append(self.spark.read.parquet(f"{self.base}/upto={at}"))
        later = [f"{self.path}/batch_id={b}" for b in self.batches()]
        if later:
            parts.append(self.spark.read.option("basePath", self.path).parquet(*later)
                         .withColumn("batch_id", F.col("batch_id").cast("long")))
        if not parts:
            return None
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return latest(rows, self.keys, self.order)

    def read(self, schema=None) -> DataFrame:
        """The winning row of every key; an empty frame of ``schema`` when nothing was written."""
        rows = self._rows()
        if rows is None:
            return self.spark.createDataFrame([], schema)
        return rows.drop("batch_id")

    def fold(self) -> None:
        """Merge the base and the batches after it into a new base, then drop what the base before replaced."""
        before, later = self.bases(), self.batches()
        if not later:
            return
        self._rows().write.mode("overwrite").parquet(f"{self.base}/upto={later[-1]}")
        for m in before[:-1]:
            self._delete(f"{self.base}/upto={m}")
        for b in self._numbered(self.path, "batch_id"):
            if before and b <= before[-1]:
                self._delete(f"{self.path}/batch_id={b}")

    def _delete(self, path: str) -> None:
        p, fs = self._fs(path)
        fs.delete(p, True)
