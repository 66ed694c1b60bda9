"""Makes this package importable in the Python workers of any cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once for each SparkContext."""
    # Rows here are whole texts: smaller Arrow batches keep Python workers small. A size set by the user stays.
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "1000")
    context = spark.sparkContext
    if getattr(context, "_docpipe_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="docpipe-src-")
    archive = os.path.join(os.path.abspath(folder), "docpipe_sources.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for root, _, names in sorted(os.walk(top)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    z.write(full, os.path.join("docpipe", os.path.relpath(full, top)))
    context.addPyFile(archive)
    context._docpipe_shipped = True


ROWS = 20_000  # of a partition, at most, where rows cost much more CPU than their bytes in the file


def spread(scan: DataFrame) -> DataFrame:
    """A file scan over all cores, for steps that cost much CPU a row.

    Splits are cut by bytes of the file, so packed or dictionary-coded rows come in
    millions to a task, and a file of one row group leaves all but one split empty.
    A scan with fewer partitions than the cluster has cores, or than its rows need
    at ROWS a partition, is dealt out; any other scan is left as it is. Only for
    plain scans: partitions and rows are counted by planning and from file footers.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    wanted = max(cores, -(-scan.count() // ROWS))
    return scan.repartition(wanted) if scan.rdd.getNumPartitions() < wanted else scan
