"""Where intermediate results and stream progress are kept."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Where nothing is named, a session on one machine gets a temporary folder; on a cluster, where executors
    could not see that, it is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="rillflow-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below :func:`shared_folder`."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


class Scratch:
    """Folders below :func:`shared_folder` that are deleted when the block ends.

    What is returned from the block must not read them any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.last = spark, [], {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        for path in self.paths:
            delete_folder(self.spark, path)

    def folder(self, purpose: str) -> str:
        self.paths.append(run_folder(self.spark, purpose))
        return self.paths[-1]

    def written(self, df: DataFrame, purpose: str) -> DataFrame:
        """``df`` written as Parquet and read again."""
        path = self.folder(purpose)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def renewed(self, df: DataFrame, purpose: str) -> DataFrame:
        """``df`` written like ``written`` does; what this wrote for the purpose before, which only ``df`` may still need, is deleted."""
        old, self.last[purpose] = self.last.get(purpose), len(self.paths)
        out = self.written(df, purpose)
        if old is not None:
            delete_folder(self.spark, self.paths[old])
        return out


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute a frame once and store it reliably."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
