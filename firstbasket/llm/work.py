"""Written intermediate tables and small helpers shared by the operators of this package.

Intermediate tables are Parquet under the folder that the session names in ``spark.checkpoint.dir``
(shared by driver and executors), so a lost executor costs a re-read and not a recomputation, and a
later join sees real sizes. Each run of an operator has a folder of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


#: Of texts that a task hands to Python at once. Spark's own setting is 64 MB, which the executor and
#: the worker each hold several times over.
BATCH_BYTES = "4m"


def bounded_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by their size unless the session says how."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, BATCH_BYTES)


class Work:
    """A folder of written tables for one run of an operator."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self._n = 0
        bounded_batches(spark)

    def save(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Writes ``df`` and returns a frame that reads the written files."""
        self._n += 1
        path = f"{self.folder}/{self._n:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._work_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Deletes tables that ``save`` wrote and that nothing reads any more."""
        for df in frames:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(df._work_path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """Column names like ``wanted`` that clash with none of ``taken`` (whatever their case)."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def named(columns: Iterable[str], name: str) -> str:
    """``name`` quoted for use in a column expression."""
    return "`" + name.replace("`", "``") + "`"


def null_safe(left: list[Column], right: list[Column]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & a.eqNullSafe(b)
    return cond


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
