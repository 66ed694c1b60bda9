"""File sinks for results that other tools read one file at a time.

Tables go to Parquet through Spark's own writers. Many small files are written
by the executors; one large document too, as parts that are joined byte by byte.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ..scratch import settled

CHUNK_BYTES = 1 << 20


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)


def write_text(spark: SparkSession, path: str, parts: Iterable[str]) -> None:
    out = _open(spark, path)
    try:
        for part in parts:
            data = part.encode()
            for a in range(0, len(data), CHUNK_BYTES):
                out.write(bytearray(data[a : a + CHUNK_BYTES]))
    finally:
        out.close()


def wipe(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _file_rows(root: str):
    def run(batches):
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(root if "://" in root else f"file://{os.path.abspath(root)}")
        made = set()
        for batch in batches:
            paths, errors = batch.column("path").to_pylist(), []
            for path, text in zip(paths, batch.column("text").to_pylist()):
                try:
                    full = f"{top.rstrip('/')}/{path}"
                    folder = full.rpartition("/")[0]
                    if folder not in made:
                        store.create_dir(folder, recursive=True)
                        made.add(folder)
                    with store.open_output_stream(full) as out:
                        out.write((text or "").encode())
                    errors.append(None)
                except Exception as e:  # a file that fails is reported; the others go on
                    errors.append(str(e)[:200])
            yield pa.RecordBatch.from_pydict({"path": paths, "error": pa.array(errors, pa.string())})

    return run


def write_files(rows: DataFrame, root: str, path: str = "path", text: str = "text", clean: bool = False) -> DataFrame:
    """One file a row below root, written by the executors; (path, error) of each file.

    Of rows with the same path the one with the greatest text stays, and no two
    tasks write one file, so a task that runs again gives the same files. root is
    a folder or address that all executors reach (file, hdfs, s3, gs).
    """
    from pyspark.sql import functions as F

    spark = rows.sparkSession
    if clean:
        wipe(spark, root)
    once = rows.where(rows[path].isNotNull()).groupBy(F.col(path).alias("path")).agg(F.max(text).alias("text"))
    return settled(once.mapInArrow(_file_rows(root), "path string, error string"))


def write_pages(pages: DataFrame, root: str) -> DataFrame:
    """Normalised pages (doc_path, body) in the same tree, .mdx as .md."""
    from pyspark.sql import functions as F

    return write_files(pages.select(F.regexp_replace("doc_path", r"\.mdx$", ".md").alias("path"), F.col("body").alias("text")), root)


def write_json_export(chunks: DataFrame, path: str, head: dict) -> None:
    """One JSON document {..., "chunks": [...]}, chunks in file and chunk order, a chunk a line.

    The executors write the lines as sorted parts; the driver's JVM only copies the
    parts' bytes one after another, through a small buffer.
    """
    from pyspark.sql import functions as F

    spark = chunks.sparkSession
    parts = f"{path}.{uuid.uuid4().hex}"
    line = F.concat(F.to_json(F.struct(*chunks.columns)), F.lit(","))
    chunks.orderBy("doc_path", "chunk_seq").select(line.alias("value")).write.option("lineSep", "\n").option("compression", "none").text(parts)
    start = json.dumps(head, ensure_ascii=False, default=str)
    start = start[:-1] + (", " if head else "") + '"chunks": ['
    jvm, folder = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(parts)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s for s in store.listStatus(folder) if s.getPath().getName().startswith("part-") and s.getLen()]
    found.sort(key=lambda s: int(s.getPath().getName().split("-")[1]))
    out = _open(spark, path)
    try:
        out.write(bytearray((start + "\n").encode()))
        for i, status in enumerate(found):
            size = status.getLen() - 2 * (i == len(found) - 1)  # the last line has no comma, nor a line end of its own
            part = store.open(status.getPath())
            try:
                jvm.org.apache.commons.io.IOUtils.copyLarge(part, out, 0, size)
            finally:
                part.close()
        out.write(bytearray(b"\n]}" if found else b"]}"))
    finally:
        out.close()
        wipe(spark, parts)


def read_json_export(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of such a document (or of any with a `chunks` array).

    A document as write_json_export writes it has a chunk a line, so its lines are
    read in splits by all executors. Any other layout is one value, read by one task.
    """
    from pyspark.sql import functions as F

    lines = spark.read.text(path, lineSep="\n").where("trim(value) <> ''")
    bad = "__not_a_row"
    schema = spark.read.json(path, lineSep="\n", columnNameOfCorruptRecord=bad).schema
    names = [n for n in schema.names if n != bad]
    kind = StructType([f for f in schema.fields if f.name != bad] + [StructField(bad, StringType())])
    row = F.from_json(F.regexp_replace("value", r",\s*$", ""), kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    rows = lines.select("value", F.inline(F.array(row)))  # a generator: read once a line, whatever is asked of it
    frame = [r.value for r in rows.where(F.col(bad).isNotNull()).select("value").limit(3).collect()]
    frame.sort(key=lambda v: v.strip() == "]}")
    if names and len(frame) == 2 and frame[1].strip() == "]}" and re.search(r'"chunks"\s*:\s*\[\s*$', frame[0]):
        return rows.where(F.col(bad).isNull()).select(*(f"`{n}`" for n in names))
    return spark.read.json(path, multiLine=True).selectExpr("inline(chunks)")
