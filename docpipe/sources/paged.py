"""Object stores that list a page of keys at a time, as a Spark data source.

    spark.dataSource.register(PagedSource)
    spark.read.format("paged_store").option("store", "my.module:open_store").option("path", place).load()
    rows.write.format("paged_store").option(...).mode("append").save()

Reading lists keys: a partition for each key prefix, which follows continuation
tokens page by page. Filters on the key are pushed down: equality and IN become
existence probes of those keys alone, a prefix narrows the listing (with
spark.sql.python.filterPushdown.enabled). Writing is a two-phase commit: each task
stages its objects under a token of its own, and the driver publishes the tokens of
the tasks that count in one step. So a task that runs twice stores once, and a job
that fails leaves nothing to be seen.

`store` names a callable that opens a Store from `path`; FolderStore, the default,
keeps objects in a folder that all executors share.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import ExitStack
from dataclasses import dataclass
from heapq import merge
from importlib import import_module
from itertools import chain, groupby, islice
from operator import itemgetter
from typing import Protocol

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage

from ..shipping import ship

PAGE = 1000  # keys of one listing or probe
SHARD = 2  # first signs of a key that name the part of the index a probe looks into
SPAN = 4096  # bytes of an index file read at a time while a key is looked for
CLOSED = (None, None, iter(()))
HEX = "0123456789abcdef"  # keys are content hashes: their first digits
SCHEMA = "key string, size long"
WRITE_SCHEMA = "key string, content string, facts map<string,string>"


class Store(Protocol):
    def page(self, prefix: str, after: str | None, most: int) -> tuple[list[tuple[str, int]], str | None]:
        """(key, size) of up to `most` objects in key order, and the token of the next page or None."""

    def probe(self, keys: list[str]) -> list[tuple[str, int]]:
        """(key, size) of those of the keys that exist."""

    def stage(self, token: str, objects: Iterable[tuple[str, str, dict]]) -> int: ...
    def publish(self, job: str, tokens: list[str]) -> None: ...
    def discard(self, tokens: list[str]) -> None: ...


class FolderStore:
    """Objects as one file for each staged token, its keys in order in another, and the published tokens of each job in a file; any path that pyarrow opens."""

    def __init__(self, path: str):
        self.fs, self.root = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")
        self.open, self.shard = CLOSED, (None, {})

    def _names(self, folder: str) -> list[str]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/{folder}", allow_not_found=True))
        return sorted(f.base_name for f in found)

    def _put(self, lines: dict[str, Iterator[str]]) -> None:
        """Files that appear whole or not at all; their lines are written side by side, as they come."""
        drafts = {name: f"{self.root}/drafts/{uuid.uuid4().hex}" for name in lines}
        for folder in {"drafts", *(name.rsplit("/", 1)[0] for name in lines)}:
            self.fs.create_dir(f"{self.root}/{folder}", recursive=True)
        with ExitStack() as stack:
            streams = [stack.enter_context(self.fs.open_output_stream(d)) for d in drafts.values()]
            for row in zip(*lines.values()):
                for stream, line in zip(streams, row):
                    stream.write(line.encode() + b"\n")
        for name, draft in drafts.items():
            self.fs.move(draft, f"{self.root}/{name}")

    def _lines(self, name: str) -> list:
        with self.fs.open_input_stream(f"{self.root}/{name}") as f:
            return [json.loads(x) for x in f.read().decode().split("\n") if x]

    def _index(self, token: str, prefix: str, after: str | None) -> Iterator[tuple[str, int]]:
        """(key, size) of a token with a prefix and behind a key; index files are in key order, so only that part is read."""
        low = max(prefix, after or "")
        with self.fs.open_input_file(f"{self.root}/index/{token}") as f:

            def line(at: int) -> tuple[int, str | None]:
                """Where the line behind a place ends, and its key."""
                raw, end = b"", f.size()
                while raw.count(b"\n") < 2 and at + len(raw) < end:
                    raw += f.read_at(min(SPAN, end - at - len(raw)), at + len(raw))
                whole = raw.split(b"\n", 2)
                return (at + len(whole[0]) + len(whole[1]) + 2, json.loads(whole[1])[0]) if len(whole) > 2 else (end, None)

            begin, end = 0, f.size()  # the line at begin starts there, and no line behind end is the first wanted
            while end - begin > 16 * SPAN:
                middle = (begin + end) // 2
                to, key = line(middle)
                if key is None or key >= low or to >= end:
                    end = middle
                else:
                    begin = to
            f.seek(begin)
            rest, found = b"", []
            while data := f.read(16 * SPAN):
                *lines, rest = (rest + data).split(b"\n")
                found += lines
                if lines and not (key := json.loads(lines[-1])[0]).startswith(prefix) and key > low:
                    break
        for raw in found:
            key, size = json.loads(raw)
            if key.startswith(prefix) and (after is None or key > after):
                yield key, size
            elif key > low:
                return

    def _listed(self, prefix: str, after: str | None) -> Iterator[tuple[str, int]]:
        """Published (key, size) with a prefix, behind a key, in key order. Of equal keys the first published holds."""
        tokens = [t for job in self._names("published") for t in self._lines(f"published/{job}")]
        last = None
        for key, size in merge(*(self._index(t, prefix, after) for t in tokens), key=itemgetter(0)):  # stable: in order of tokens
            if key != last:
                yield key, size
            last = key

    def page(self, prefix: str, after: str | None, most: int) -> tuple[list[tuple[str, int]], str | None]:
        if after is None or self.open[:2] != (prefix, after):
            self.open = (prefix, after, self._listed(prefix, after))
        rows = self.open[2]
        some = list(islice(rows, most))
        more = list(islice(rows, 1))
        if not more:
            self.open = CLOSED
            return some, None
        self.open = (prefix, some[-1][0], chain(more, rows))  # the next page goes on here
        return some, some[-1][0]

    def probe(self, keys: list[str]) -> list[tuple[str, int]]:
        """Keys are looked up by their first SHARD signs; the last such part is kept, so keys in order read each part once."""
        found = {}
        for shard, some in groupby(sorted(set(keys)), lambda k: k[:SHARD]):
            if self.shard[0] != shard:
                self.shard = (shard, dict(self._listed(shard, None)))
            found |= {k: self.shard[1][k] for k in some if k in self.shard[1]}
        return [(k, found[k]) for k in keys if k in found]

    def stage(self, token: str, objects: Iterable[tuple[str, str, dict]]) -> int:
        index: list[tuple[str, int]] = []

        def whole() -> Iterator[str]:
            for n, (key, content, facts) in enumerate(objects):
                index.append((key, len((content or "").encode())))
                yield json.dumps([key, content, facts, n])

        self._put({f"objects/{token}": whole()})
        self._put({f"index/{token}": map(json.dumps, sorted(index))})
        return len(index)

    def publish(self, job: str, tokens: list[str]) -> None:
        number = len(self._names("published"))
        self._put({f"published/{number:08d}-{job}": map(json.dumps, tokens)})

    def discard(self, tokens: list[str]) -> None:
        for token in tokens:
            for folder in ("objects", "index"):
                if self.fs.get_file_info(f"{self.root}/{folder}/{token}").type == pafs.FileType.File:
                    self.fs.delete_file(f"{self.root}/{folder}/{token}")


def open_store(options: dict) -> Store:
    module, _, name = options.get("store", "docpipe.sources.paged:FolderStore").partition(":")
    return getattr(import_module(module), name)(options["path"])


@dataclass
class Keys(InputPartition):
    """A prefix to list, or keys to probe."""

    prefix: str = ""
    probe: tuple[str, ...] | None = None


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)
        self.size = int(options.get("page", PAGE))
        self.prefixes: list[str] = [p for p in options.get("prefixes", ",".join(HEX)).split(",")]
        self.keys: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and IN on the key become probes, a prefix narrows the listing; other filters go back to Spark."""
        for f in filters:
            on_key = getattr(f, "attribute", None) == ("key",)
            if on_key and isinstance(f, EqualTo | In):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.keys = wanted if self.keys is None else self.keys & wanted
            elif on_key and isinstance(f, StringStartsWith):
                narrowed = [max(p, f.value, key=len) for p in self.prefixes if p.startswith(f.value) or f.value.startswith(p)]
                self.prefixes = sorted(set(narrowed))
                yield f  # probes, if there are any, don't look at prefixes
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        if self.keys is None:
            return [Keys(p) for p in self.prefixes]
        keys = sorted(k for k in self.keys if k is not None)
        return [Keys(probe=tuple(keys[a : a + self.size])) for a in range(0, len(keys), self.size)]

    def read(self, partition: Keys) -> Iterator[pa.RecordBatch]:
        store = open_store(self.options)
        if partition.probe is not None:
            yield _listed(store.probe(list(partition.probe)))
            return
        after: str | None = None
        while True:
            found, after = store.page(partition.prefix, after, self.size)
            yield _listed(found)
            if after is None:
                return


def _listed(found: list[tuple[str, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["key", "size"])


@dataclass
class Staged(WriterCommitMessage):
    token: str
    objects: int


class PagedWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.options = dict(options)
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Staged:
        """Stage a task's rows; of equal keys in a task the first counts. What a failing task has staged goes at once."""
        store = open_store(self.options)
        token = f"{self.job}-{uuid.uuid4().hex}"
        seen: set[str] = set()

        def objects() -> Iterator[tuple[str, str, dict]]:
            for row in iterator:
                if row["key"] not in seen:
                    seen.add(row["key"])
                    yield row["key"], row["content"], dict(row["facts"] or {})

        try:
            return Staged(token, store.stage(token, objects()))
        except BaseException:
            store.discard([token])
            raise

    def commit(self, messages: list[Staged | None]) -> None:
        open_store(self.options).publish(self.job, [m.token for m in messages if m and m.objects])

    def abort(self, messages: list[Staged | None]) -> None:
        open_store(self.options).discard([m.token for m in messages if m])


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_store"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)

    def writer(self, schema, overwrite: bool) -> PagedWriter:
        if overwrite:
            raise ValueError("a paged store only takes new objects: use mode append")
        return PagedWriter(self.options)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedSource)


def listing(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(key, size) of the objects of a store."""
    register(spark)
    return spark.read.format("paged_store").options(path=path, **options).load()


def existing(ids: DataFrame, path: str, key: str = "content_hash", **options: str) -> DataFrame:
    """The ids (distinct) that the store has, by probes of PAGE keys at a time where the ids are; no listing, nothing on the driver."""
    ship(ids.sparkSession)
    given = {"path": path, **options}
    size = int(options.get("page", PAGE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = open_store(given)
        for batch in batches:
            keys = [k for k in batch.column(0).to_pylist() if k is not None]
            for a in range(0, len(keys), size):
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in store.probe(keys[a : a + size])], pa.string())], names=[key])

    # Keys in order and those of a part of the index together, so that a task reads its parts only, each once.
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = ids.select(F.col(key).cast("string").alias(key)).distinct().repartition(parts, F.substring(key, 1, SHARD)).sortWithinPartitions(key)
    return wanted.mapInArrow(run, f"{key} string")


def put(rows: DataFrame, path: str, **options: str) -> None:
    """Store rows (key, content, facts) that are not there yet, in one commit; equal keys once."""
    from ..operators.ranking import keep_first

    register(rows.sparkSession)
    have = existing(rows.select("key"), path, "key", **options)
    new = rows.select("key", "content", "facts").join(have, "key", "left_anti")  # first, so that texts are moved once
    new = keep_first(new, "key", "content")
    new.write.format("paged_store").options(path=path, **options).mode("append").save()
