"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# The shuffle files of a written table are not needed once it is written.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, one of our own, in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="docpipe-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_left: list[str] = []  # folders of this process that a returned DataFrame may still read


def release(spark: SparkSession) -> None:
    """Remove what finished runs of this process left in the shared folder.

    The DataFrames that the operators return read a last table there, so call
    this when their results are written; a job's end is the usual place.
    """
    while _left:
        remove(spark, _left.pop())


class Scratch:
    """Tables of one run; lineage ends at each, so a lost executor costs one step."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark).rstrip('/')}/docpipe-{name}-{uuid.uuid4().hex}"
        self.paths: list[str] = []
        _left.append(self.path)

    def save(self, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{len(self.paths) + 1}"
        self.paths.append(path)
        held = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(_CLEANUP, held)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._docpipe_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            remove(self.spark, table._docpipe_path)

    def clear(self, *but: DataFrame) -> None:
        """Remove all tables of this run but those named."""
        held = {t._docpipe_path for t in but}
        for path in self.paths:
            if path not in held:
                remove(self.spark, path)
