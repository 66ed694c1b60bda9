"""A keyed table in Parquet whose writes touch only the buckets of the keys they change.

A row's bucket is a hash of its key. A write adds a generation: a folder with a
folder for each bucket it touches. A pointer file lists the generations of every
bucket, oldest first; the newest row of a key holds, and rows marked as gone hide
it. A bucket with more than `most` generations is rewritten as one, alone. Readers
follow the pointer, so a write that is lost half-way is never seen; what the pointer
no longer names stays for `grace` seconds, for readers that began before, and for
one move of the pointer (CURRENT.old stands in if that is cut short).
"""

from __future__ import annotations

import re
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

Manifest = dict[int, list[str]]


class BucketedTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str, buckets: int = 64, most: int = 8, grace: float = 3600.0, clock=time.time):
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key
        self.buckets, self.most, self.grace, self.clock = buckets, most, grace, clock
        self.stored = StructType([*schema.fields, StructField("gone", BooleanType()), StructField("bucket", IntegerType())])

    # --- files ---

    def _path(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _children(self, name: str = "") -> list[tuple[str, float]]:
        """(name, seconds of the last change) of what lies in a folder; small: generations, or buckets of one."""
        fs, p = self._path(name)
        if not fs.exists(p):
            return []
        return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(p)]

    def remove(self, name: str) -> None:
        fs, p = self._path(name)
        fs.delete(p, True)

    def _read(self, name: str) -> tuple[Manifest, list[tuple[str, float]]] | None:
        """(generations by bucket, retired folders with the time they were) of a pointer file."""
        fs, p = self._path(name)
        if not fs.exists(p):
            return None
        live: Manifest = {}
        retired = []
        for (line,) in self.spark.read.text(f"{self.root}/{name}").collect():
            first, *rest = line.split()
            if first == "retired":
                retired.append((rest[0], float(rest[1])))
            elif rest:
                live[int(first)] = rest
        return live, retired

    def manifest(self) -> Manifest:
        return (self._read("CURRENT") or self._read("CURRENT.old") or ({}, []))[0]

    def _point(self, live: Manifest, retired: list[tuple[str, float]]) -> None:
        draft = f"CURRENT.{uuid.uuid4().hex}"
        lines = [f"{b} {' '.join(g)}" for b, g in sorted(live.items())] + [f"retired {n} {t}" for n, t in retired]
        fs, new = self._path(draft)
        out = fs.create(new, True)
        out.write(bytearray(("\n".join(lines or ["0"])).encode()))
        out.close()
        (_, pointer), (_, old) = self._path("CURRENT"), self._path("CURRENT.old")
        if fs.exists(pointer):
            fs.delete(old, False)
            fs.rename(pointer, old)
        fs.rename(new, pointer)

    # --- rows ---

    def _generations(self, live: Manifest, only: list[int] | None = None) -> DataFrame | None:
        """All rows of the generations that live names, each with its age; buckets that a generation has no more are pruned."""
        of: dict[str, list[int]] = {}
        for b, names in live.items():
            if only is None or b in only:
                for n in names:
                    of.setdefault(n, []).append(b)
        parts = []
        # Names begin with a number that grows with each write.
        for age, (name, held) in enumerate(sorted(of.items())):
            rows = self.spark.read.schema(self.stored).parquet(f"{self.root}/{name}")
            parts.append(rows.where(F.col("bucket").isin(held)).withColumn("age", F.lit(age)))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def _newest(self, live: Manifest, only: list[int] | None = None, keep_gone: bool = False) -> DataFrame:
        """The newest row of each key; the merge is one aggregate, however many generations there are."""
        rows = self._generations(live, only)
        if rows is None:
            return self.spark.createDataFrame([], self.stored)
        most = max(len(g) for b, g in live.items() if only is None or b in only)
        columns = [*self.schema.names, "gone", "bucket"]
        if most > 1:
            rest = F.struct(*(c for c in columns if c not in (self.key, "bucket")))
            rows = rows.groupBy(self.key, "bucket").agg(F.max_by(rest, "age").alias("x")).select(self.key, "bucket", "x.*")
        return (rows if keep_gone else rows.where("not gone")).select(*columns)

    def rows(self) -> DataFrame:
        return self._newest(self.manifest()).select(*self.schema.names)

    def _add(self, rows: DataFrame, number: int) -> tuple[str, list[int]]:
        """Write a generation; its name and buckets."""
        name = f"g{number:08d}-{uuid.uuid4().hex}"
        rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/{name}")
        return name, [int(n.removeprefix("bucket=")) for n, _ in self._children(name) if n.startswith("bucket=")]

    def write(self, changes: DataFrame) -> list[int]:
        """Add rows of the schema, with a column `gone`; equal keys in one write count once. The buckets touched."""
        live, retired = self._read("CURRENT") or self._read("CURRENT.old") or ({}, [])
        before = {(b, n) for b, names in live.items() for n in names}
        number = 1 + max((int(n[1:9]) for _, n in before), default=0)
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        rows = changes.select(*self.schema.names, "gone").groupBy(self.key).agg(F.first(F.struct(*(c for c in self.schema.names if c != self.key), "gone")).alias("x"))
        name, touched = self._add(rows.select(self.key, "x.*").withColumn("bucket", bucket), number)
        live = {**live, **{b: [*live.get(b, []), name] for b in touched}}
        full = [b for b in touched if len(live[b]) > self.most]
        if full:
            whole, _ = self._add(self._newest(live, full), number + 1)
            live |= {b: [whole] for b in full}
        after = {(b, n) for b, names in live.items() for n in names}
        now = self.clock()
        retired += [(f"{n}/bucket={b}", now) for b, n in sorted((before | {(b, name) for b in touched}) - after)]
        self._point(live, retired)
        self.clean()
        return touched

    def clean(self) -> None:
        """Remove what was retired more than `grace` seconds ago and no pointer names, and drafts and staged folders of that age."""
        found = self._read("CURRENT")
        if found is None:
            return
        live, retired = found
        old = (self._read("CURRENT.old") or ({}, []))[0]
        named = {f"{n}/bucket={b}" for m in (live, old) for b, names in m.items() for n in names}
        limit = self.clock() - self.grace
        gone = [n for n, t in retired if t <= limit and n not in named]
        for name in gone:
            self.remove(name)
        generations = {n.split("/")[0] for n in named}
        for name, changed in self._children():
            empty = name in {g.split("/")[0] for g in gone} and not any(n.startswith("bucket=") for n, _ in self._children(name))
            lost = re.match(r"g\d{8}-|staged-|CURRENT\.[0-9a-f]{32}$", name) and changed <= limit and name not in {r.split("/")[0] for r, _ in retired}
            if name not in generations and (empty or lost):
                self.remove(name)
        left = [(n, t) for n, t in retired if n not in gone]
        if gone:
            self._point(live, left)
