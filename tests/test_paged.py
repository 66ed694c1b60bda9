"""The paged data source: listings by pages, probes, and two-phase writes."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, StringStartsWith

from docpipe.sources import paged

N = 95


def key(i):
    return hashlib.sha256(str(i).encode()).hexdigest()


class Careful(paged.FolderStore):
    """Refuses more than a page, and keeps a mark of each call."""

    def page(self, prefix, after, most):
        assert most <= 10
        self._put({f"calls/page-{prefix}-{after}": iter(["x"])})
        return super().page(prefix, after, most)

    def probe(self, keys):
        assert len(keys) <= 10
        self._put({f"calls/probe-{hash(tuple(keys))}": iter(["x"])})
        return super().probe(keys)


STORE = {"store": "tests.test_paged:Careful", "page": "10"}


@pytest.fixture
def rows(spark):
    return spark.range(N).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), F.concat(F.lit("text "), "id").alias("content"), F.create_map(F.lit("n"), F.col("id").cast("string")).alias("facts"))


def calls(path, kind):
    return sorted(p.name for p in (path / "calls").glob(f"{kind}-*")) if (path / "calls").exists() else []


def test_listing_by_pages(spark, rows, tmp_path):
    paged.put(rows, str(tmp_path), **STORE)
    before = len(calls(tmp_path, "page"))
    got = {r.key: r.size for r in paged.listing(spark, str(tmp_path), prefixes="", **STORE).collect()}
    assert got == {key(i): len(f"text {i}") for i in range(N)} and len(calls(tmp_path, "page")) - before == 10
    each = paged.listing(spark, str(tmp_path), **STORE)
    assert each.rdd.getNumPartitions() == 16 and each.count() == N
    assert paged.listing(spark, str(tmp_path / "none")).count() == 0


def test_filters_are_pushed_down(spark, rows, tmp_path):
    paged.put(rows, str(tmp_path), **STORE)
    pages = calls(tmp_path, "page")
    wanted = [key(i) for i in range(25)] + ["absent"]
    df = paged.listing(spark, str(tmp_path), **STORE)
    probed = len(calls(tmp_path, "probe"))
    assert {r.key for r in df.where(F.col("key").isin(wanted)).collect()} == set(wanted[:25])
    assert calls(tmp_path, "page") == pages and len(calls(tmp_path, "probe")) == probed + 3
    assert df.where(F.col("key") == key(3)).count() == 1 and df.where(F.col("key") == "absent").count() == 0
    assert {r.key for r in df.where(F.col("key").startswith("ab")).collect()} == {key(i) for i in range(N) if key(i).startswith("ab")}
    assert {r.key for r in df.where(F.col("key").startswith("a") & F.col("key").isin(wanted)).collect()} == {k for k in wanted[:25] if k.startswith("a")}
    assert df.where("size > 6").count() == N - 10


def test_pushed_filters():
    r = paged.PagedReader({"path": "/x"})
    left = list(r.pushFilters([In(("key",), ("b", "a", None)), EqualTo(("key",), "a"), EqualTo(("size",), 3)]))
    assert left == [EqualTo(("size",), 3)] and [p.probe for p in r.partitions()] == [("a",)]
    r = paged.PagedReader({"path": "/x"})
    assert len(list(r.pushFilters([StringStartsWith(("key",), "ab")]))) == 1 and [p.prefix for p in r.partitions()] == ["ab"]
    r = paged.PagedReader({"path": "/x", "prefixes": "abc,abd,b"})
    list(r.pushFilters([StringStartsWith(("key",), "ab")]))
    assert [p.prefix for p in r.partitions()] == ["abc", "abd"]


def test_existing(spark, rows, tmp_path):
    paged.put(rows.where("content <> 'text 5'"), str(tmp_path), **STORE)
    ids = rows.select(F.col("key").alias("content_hash")).union(rows.select("key")).union(spark.createDataFrame([(None,), ("no",)], "k string"))
    assert {r.content_hash for r in paged.existing(ids, str(tmp_path), **STORE).collect()} == {key(i) for i in range(N) if i != 5}


class Fails(paged.FolderStore):
    """Fails after it has taken some objects, once or always."""

    def stage(self, token, objects):
        def some():
            for n, row in enumerate(objects):
                if row[0] == key(7) and not self._names("once"):
                    if self.root.endswith("retry"):
                        self._put({"once/x": iter(["x"])})
                    raise OSError("lost")
                yield row

        return super().stage(token, some())


def test_a_failing_task_leaves_nothing(spark, rows, tmp_path):
    options = {"store": "tests.test_paged:Fails"}
    with pytest.raises(Exception, match="lost"):
        paged.put(rows.repartition(4), str(tmp_path), **options)
    assert paged.listing(spark, str(tmp_path), **options).count() == 0
    assert not list((tmp_path / "index").glob("*")) and not list((tmp_path / "objects").glob("*"))
    paged.put(rows.repartition(4), str(tmp_path))
    assert paged.listing(spark, str(tmp_path)).count() == N


def test_only_tokens_that_count_are_published(spark, tmp_path):
    """A task that ran twice: one of its messages reaches the commit."""
    w = paged.PagedWriter({"path": str(tmp_path)})
    one = {"key": "k1", "content": "a", "facts": None}
    first, second = w.write(iter([one, one])), w.write(iter([one]))
    assert (first.objects, second.objects) == (1, 1)
    w.commit([second, None])
    assert paged.FolderStore(str(tmp_path)).page("", None, 10) == ([("k1", 1)], None)
    x = paged.PagedWriter({"path": str(tmp_path)})
    x.abort([x.write(iter([{"key": "k2", "content": "b", "facts": {}}])), None])
    assert paged.FolderStore(str(tmp_path)).probe(["k1", "k2"]) == [("k1", 1)]
    with pytest.raises(ValueError):
        paged.PagedSource({"path": str(tmp_path)}).writer(None, True)


def test_put_stores_what_is_new(spark, rows, tmp_path):
    paged.put(rows.limit(50).union(rows.limit(50)), str(tmp_path))
    paged.put(rows, str(tmp_path))
    store = paged.FolderStore(str(tmp_path))
    stored = [k for t in store._names("index") for k, _ in store._lines(f"index/{t}")]
    assert len(stored) == N == len(set(stored))


def test_a_listing_reads_each_index_once(tmp_path, monkeypatch):
    """Pages go on where the last one ended, and probes in key order read each part of an index once."""
    store = paged.FolderStore(str(tmp_path))
    for n in range(3):
        store.stage(f"t{n}", ((key(i), "x" * (i + n), {}) for i in range(n, 6000, 2)))
        store.publish(f"j{n}", [f"t{n}"])
    want = sorted((key(i), i + i % 2) for i in range(6000))
    opened = []
    read = paged.FolderStore._index
    monkeypatch.setattr(paged.FolderStore, "_index", lambda self, *a: opened.append(a) or read(self, *a))
    store, found, after = paged.FolderStore(str(tmp_path)), [], None
    while True:
        some, after = store.page("", after, 100)
        found += some
        if after is None:
            break
    assert found == want and len(opened) == 3
    opened.clear()
    keys = [k for k, _ in want] + ["none"]
    assert [x for a in range(0, len(keys), 100) for x in store.probe(keys[a : a + 100])] == want and len(opened) == 3 * 257
    for at in (0, 1, 2999, 5998, 5999):  # another instance takes up a listing
        assert paged.FolderStore(str(tmp_path)).page("", want[at][0], 10)[0] == want[at + 1 : at + 11]
    for prefix in ("00", "7", "abc", "ff"):
        assert paged.FolderStore(str(tmp_path)).page(prefix, None, 9000) == ([x for x in want if x[0].startswith(prefix)], None)
