"""Incremental and sync runs, stores, sources, streaming."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from docpipe import config as C
from docpipe.operators import incremental, sync
from docpipe.plans import fixtures, pipeline
from docpipe.sources import files, state, stores
from docpipe.streaming.incremental import change_stream, changes, ingest_folder, latest_chunks, take_listing
from docpipe.streaming.vectors import prune, sync_stream


def test_scan(spark, tmp_path):
    for name in ("b/z.md", "a/x.mdx", "a/.git/y.md", ".hidden.md", "a/notes.txt", "dist/d.md", "a/Big.MD"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("# T")
    got = [r.doc_path for r in files.read_pages(spark, C.ScanConfig(str(tmp_path))).collect()]
    assert got == ["a/x.mdx", "b/z.md"]
    assert files.read_texts(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        C.ScanConfig("x", extensions=("md",))


def test_specs_and_navigation(spark, tmp_path):
    (tmp_path / "data/bav").mkdir(parents=True)
    (tmp_path / "data/bav/x.json").write_text("{}")
    row = files.read_specs(spark, str(tmp_path)).first()
    assert (row.category, row.product) == ("data", "bav/x")
    nav = tmp_path / "nav.json"
    nav.write_text(json.dumps({"home": [{"name": "P", "path": "pay", "children": [{"name": "U", "path": "u", "order": 1, "versions": ["v1"], "default_version": "v1"}]}]}, indent=1))
    got = files.read_navigation(spark, str(nav)).first()
    assert (got.category, got.product, got.versions) == ("pay", "U", ["v1"])
    red = tmp_path / "red.json"
    red.write_text('{"/a": "/b", "/b": "/c", "/l": "/m", "/m": "/l"}')
    end = {r.source: r.target for r in files.final_targets(files.read_redirects(spark, str(red))).collect()}
    assert end == {"/a": "/c", "/b": "/c", "/l": "/m", "/m": "/l"}
    chain = spark.createDataFrame([(f"/{i}", f"/{i + 1}") for i in range(45)] + [("/in", "/x"), ("/x", "/y"), ("/y", "/x")], "source string, target string")
    end = {r.source: r.target for r in files.final_targets(chain).collect()}
    assert all(end[f"/{i}"] == "/45" for i in range(45)) and (end["/in"], end["/x"], end["/y"]) == ("/x", "/y", "/x")
    assert files.final_targets(chain.limit(0)).count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_outputs(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError):
        files.read_outputs(spark, str(tmp_path / "data"))


def test_ingest(spark):
    body = "# One\n" + "word " * 100 + "\n## Two\n" + "text " * 1000
    pages = [("content/payments/u/a.mdx", f"---\npage_title: 'T'\nsidebar_title: S\norder: 2\n---\n{body}"), ("content/data/b.mdx", "no heading"), ("x.md", None)]
    good, failed = pipeline.ingest(spark.createDataFrame(pages, "doc_path string, text string"), {"repo_name": "r", "commit_sha": "c"})
    rows = good.orderBy("chunk_seq").collect()
    assert {r.doc_path for r in rows} == {"content/payments/u/a.mdx"} and len(rows) >= 2 and failed.count() == 0
    assert rows[0].page_context == "T | S" and rows[0].url == "https://docs.example.com/payments/u/a" and rows[0].metadata.order == 2.0
    assert all(len(r.content_hash) == 64 for r in rows)


def test_ingest_drops_whole_file(spark):
    pages = [("a.md", "# Only heading\n# Second\n" + "word " * 90), ("b.md", "# B\n" + "word " * 90)]
    good, failed = pipeline.ingest(spark.createDataFrame(pages, "doc_path string, text string"))
    assert {r.doc_path for r in good.collect()} <= {"a.md", "b.md"}
    bad = spark.createDataFrame([("a.md", "# A\n\n# B\n")], "doc_path string, text string")
    good, failed = pipeline.ingest(bad)
    assert good.count() == 0 and failed.count() == 1


def test_specs_to_chunks(spark, tmp_path):
    good, _ = pipeline.ingest_specs(fixtures.specs(spark))
    rows = good.select("metadata.*", "doc_path").distinct().collect()
    assert {r.source_type for r in rows} == {"api-spec"} and {r.product for r in rows} == {"small", "large", "old"}
    stats = pipeline.run(spark, spark.createDataFrame([("p.md", "# P\n" + "word " * 90)], "doc_path string, text string"), fixtures.specs(spark), str(tmp_path / "o")).first()
    assert stats.files == 63 - 1 + 1 and stats.chunks >= stats.files


def test_incremental_run(spark, tmp_path):
    out = str(tmp_path / "o")
    page = lambda name, n: (f"{name}.md", f"# {name}\n" + " ".join(f"{name}{i}" for i in range(n)))
    go = lambda rows, **k: pipeline.run(spark, spark.createDataFrame(rows, "doc_path string, text string"), None, out, **k).first()
    first = go([page("a", 100), page("b", 2000), page("gone", 100)])
    assert (first.processed, first.skipped, first.deleted, first.files) == (3, 0, 0, 3)
    before = {(r.doc_path, r.chunk_seq): r.content_hash for r in pipeline.load_previous(spark, out).collect()}
    second = go([page("a", 101), page("b", 2000), page("new", 90)])
    assert (second.processed, second.skipped, second.deleted, second.files) == (2, 1, 1, 3)
    rows = pipeline.load_previous(spark, out).collect()
    assert {(r.doc_path, r.status) for r in rows} == {("a.md", "updated"), ("b.md", "kept"), ("new.md", "new")}
    kept = {(r.doc_path, r.chunk_seq): r.content_hash for r in rows if r.doc_path == "b.md"}
    assert len(kept) > 2 and kept == {k: v for k, v in before.items() if k[0] == "b.md"}
    same = go([page("a", 101), page("b", 2000), page("new", 90)])
    assert (same.processed, same.skipped) == (0, 3)
    assert go([page("a", 101)], full=True).processed == 1
    git = {"commit_sha": "one"}
    go([page("a", 101)], git=git)
    assert go([page("a", 101)], git=git, by_revision=True).skipped == 1
    assert go([page("a", 101)], git={"commit_sha": "two"}, by_revision=True).processed == 1
    os.rename(f"{out}/chunks", f"{out}/chunks.old")  # a swap that was cut short
    assert go([page("a", 101)]).skipped == 1


def test_incremental_specs(spark, tmp_path):
    out = str(tmp_path / "o")
    pages = spark.createDataFrame([("p.md", "# P\n" + "word " * 90)], "doc_path string, text string")
    one = pipeline.run(spark, pages, fixtures.specs(spark), out).first()
    two = pipeline.run(spark, pages, fixtures.specs(spark), out).first()
    assert (two.processed, two.skipped, two.chunks) == (0, 5, one.chunks)
    assert {r.status for r in pipeline.load_previous(spark, out).collect()} == {"kept"}


def frame(spark, rows, schema="doc_path string, section string, content_hash string, pos int"):
    return spark.createDataFrame(rows, schema).withColumn("chunk_id", F.concat_ws("::", "doc_path", "section"))


def test_merge(spark):
    old = frame(spark, [("a", "s", "1", 0), ("a", "s", "2", 1), ("b", "s", "3", 2), ("c", "s", "4", 3), ("gone", "s", "5", 4)])
    new = frame(spark, [("a", "s", "2", 0), ("a", "n", "9", 1), ("b", "s", "33", 2)])
    got = lambda **k: {(r.chunk_id, r.status) for r in incremental.merge_chunks(new, old, new, "pos", **k).collect()}
    fresh = {("a::s", "unchanged"), ("a::n", "new"), ("b::s", "updated"), ("c::s", "kept")}
    assert got() == fresh | {("gone::s", "kept")}
    assert got(current=spark.createDataFrame([("a",), ("b",), ("c",)], "doc_path string")) == fresh
    assert incremental.compare_runs(old, new, "pos").first().asDict() == {"added": 1, "removed": 2, "modified": 1, "unchanged": 1}
    assert not incremental.validate_unchanged(old, new, old.select("doc_path"), "pos").first().ok
    assert incremental.validate_unchanged(new, new, new.select("doc_path"), "pos").first().ok


def test_same_chunk(spark):
    a = frame(spark, [("a", "s", "1", 0), ("b", "s", "2", 1)])
    b = frame(spark, [("a", "s", "1", 5), ("b", "s", "3", 1)])
    assert a.alias("x").join(b.alias("y"), incremental.chunks_equal("x", "y")).count() == 1


def test_files_to_process(spark):
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("n", "3")], "doc_path string, file_hash string")
    old = spark.createDataFrame([("a", "1"), ("b", "x"), ("g", "4")], "doc_path string, file_hash string")
    run = lambda *a: {r.doc_path: r.action for r in incremental.files_to_process(now, *a).collect()}
    assert run(old, "s", "s") == {"a": "skip", "b": "process", "n": "process", "g": "deleted"}
    assert run(old, "unknown", "unknown")["a"] == "process"
    assert run(None, "s", "s") == {"a": "process", "b": "process", "n": "process"}


CHUNK = "content_hash string, content string, token_count int, doc_path string, metadata map<string,string>, file_seq int, chunk_seq int"


class Failing(stores.HashEmbedder):
    def embed(self, text):
        if text == "bad":
            raise RuntimeError("no")
        return super().embed(text)


def test_sync(spark, tmp_path):
    store = stores.ParquetVectorStore(spark, str(tmp_path / "v"))
    rows = [(f"h{i}", f"t{i}", 100, "a", {"k": str(i)}, 0, i) for i in range(5)] + [("h0", "t0", 100, "a", {}, 0, 9), ("small", "s", 10, "a", {}, 0, 10)]
    none = spark.createDataFrame([], "content_hash string")
    one = sync.sync(spark.createDataFrame(rows, CHUNK), none, store, stores.HashEmbedder(8))
    assert (one.plan, one.written, store.count()) == ({"insert": 5}, 5, 5)
    again = [*rows[1:5], ("new", "n", 60, "a", {}, 0, 11)]
    two = sync.sync(spark.createDataFrame(again, CHUNK), one.hashes, store, stores.HashEmbedder(8))
    assert (two.plan, two.written, two.refreshed) == ({"insert": 1, "update": 4, "delete": 1}, 1, 4)
    assert {r.content_hash for r in two.hashes.collect()} == {"h1", "h2", "h3", "h4", "new"}
    same = sync.sync(spark.createDataFrame(again, CHUNK), two.hashes, store, Failing(8))
    assert same.written == 0 and same.refreshed == 5
    dry = sync.sync(spark.createDataFrame(rows, CHUNK), none, store, Failing(8), dry_run=True)
    assert dry.written == 0 and store.count() == 5
    with pytest.raises(RuntimeError):
        sync.sync(spark.createDataFrame([("x", "bad", 100, "a", {}, 0, 0)], CHUNK), none, store, Failing(8))
    store.backup(str(tmp_path / "backup"))
    assert spark.read.json(str(tmp_path / "backup")).count() == 5


class Counted(stores.HashEmbedder):
    """Leaves a mark for every call; fails when its file says so."""

    def __init__(self, folder):
        super().__init__(8)
        self.folder = folder

    def embed(self, text):
        with open(f"{self.folder}/calls", "a") as f:
            f.write(text + "\n")
        return super().embed(text)


def test_sync_goes_on_after_a_crash(spark, tmp_path):
    rows = spark.createDataFrame([(f"h{i:03}", f"t{i}", 100, "a", {}, 0, i) for i in range(50)], CHUNK)
    store, saved = stores.ParquetVectorStore(spark, str(tmp_path / "v")), []

    def crash(kept):
        saved.append(kept.count())
        if len(saved) == 2:
            raise KeyboardInterrupt

    state_of = lambda: store.vectors(spark).select(F.col("id").alias("content_hash"))
    with pytest.raises(KeyboardInterrupt):
        sync.sync(rows, state_of(), store, Counted(str(tmp_path)), stage_size=10, save=crash)
    assert saved == [10, 20]
    two = sync.sync(rows, state_of(), store, Counted(str(tmp_path)), stage_size=10)
    assert (two.written, two.refreshed, two.stages, two.calls) == (30, 20, 3, 30)
    calls = (tmp_path / "calls").read_text().split()
    assert len(calls) == 50 == len(set(calls)) and store.count() == 50


def test_sync_stages_and_breaker(spark, tmp_path):
    rows = spark.createDataFrame([(f"h{i:03}", f"t{i}", 100, "a", {}, 0, i) for i in range(50)], CHUNK)
    none = spark.createDataFrame([], "content_hash string")

    class Weak(stores.ParquetVectorStore):
        bad, tries = 0, 0

        def upsert(self, rows):
            self.tries += 1
            if self.tries <= self.bad:
                raise OSError("down")
            super().upsert(rows)

        def delete(self, ids):
            raise OSError("down")

    waits = []
    weak = Weak(spark, str(tmp_path / "w"))
    weak.bad = 3  # the first stage fails for good
    r = sync.sync(rows, none, weak, stores.HashEmbedder(8), stage_size=10, sleep=waits.append)
    assert (r.written, r.failed, r.stages) == (40, 10, 5) and waits == [1, 2]
    dead = Weak(spark, str(tmp_path / "d"))
    dead.bad = 99
    with pytest.raises(RuntimeError):
        sync.sync(rows, none, dead, stores.HashEmbedder(8), stage_size=10, sleep=waits.append)
    assert dead.tries == 3 * C.BREAKER
    with pytest.raises(OSError):
        sync.sync(rows.limit(0), weak.vectors(spark).select(F.col("id").alias("content_hash")), weak, stores.HashEmbedder(8), sleep=waits.append)
    few = sync.sync(rows, none, stores.ParquetVectorStore(spark, str(tmp_path / "f")), stores.HashEmbedder(8), stage_size=1, most_stages=4)
    assert few.stages == 4 and few.written == 50


def test_store_versions(spark, tmp_path):
    store = stores.ParquetVectorStore(spark, str(tmp_path / "v"), most_changes=3)
    row = lambda i, k: spark.createDataFrame([(f"i{i}", [1.0], {"k": str(k)})], stores.VECTOR_SCHEMA)
    for k in range(9):
        store.upsert(row(k % 2, k))
    store.delete(row(0, 0))
    assert [(r.id, r.metadata["k"]) for r in store.vectors(spark).collect()] == [("i1", "7")]
    store.upsert(row(0, 10))
    assert store.count() == 2
    (tmp_path / "v/CURRENT").unlink()  # a move that was cut short: the version before
    assert store.count() == 1
    store.backup(str(tmp_path / "b"))
    assert spark.read.json(str(tmp_path / "b")).count() == 1


def test_writes_touch_their_buckets_only(spark, tmp_path):
    root = tmp_path / "v"
    rows = spark.range(2000).select(F.concat(F.lit("id"), "id").alias("id"), F.array(F.col("id").cast("float")).alias("embedding"), F.create_map(F.lit("k"), F.lit("old")).alias("metadata"))
    store = stores.ParquetVectorStore(spark, str(root), buckets=32, most_changes=2, grace=0)
    store.upsert(rows)
    first = {p: p.stat().st_mtime_ns for p in root.rglob("*.parquet")}
    assert len({p.parent.name for p in first}) == 32
    few = rows.where("embedding[0] % 100 = 7").withColumn("metadata", F.create_map(F.lit("k"), F.lit("new")))
    buckets = {r.b for r in few.select(F.pmod(F.xxhash64("id"), F.lit(32)).alias("b")).collect()}
    assert len(buckets) < 20
    new = lambda: {p for p in root.rglob("*.parquet") if p not in first}
    assert set(store.table.write(few.withColumn("gone", F.lit(False)))) == buckets
    assert {int(p.parent.name.removeprefix("bucket=")) for p in new()} == buckets
    assert all(p.stat().st_mtime_ns == t for p, t in first.items())
    store.delete(few.where("embedding[0] < 1000"))  # the third write of these buckets: they are rewritten, alone
    store.delete(few.where("embedding[0] < 1000"))
    got = {r.id: r.metadata["k"] for r in store.vectors(spark).collect()}
    want = {f"id{i}": "new" if i % 100 == 7 else "old" for i in range(2000) if i % 100 != 7 or i >= 1000}
    assert got == want
    untouched = {p for p in first if int(p.parent.name.removeprefix("bucket=")) not in buckets}
    assert all(p.exists() and p.stat().st_mtime_ns == first[p] for p in untouched)
    store.upsert(rows.limit(1))
    store.table.clean()
    named = {f"{n}/bucket={b}" for b, names in store.table.manifest().items() for n in names}
    on_disk = {f"{p.parent.parent.name}/{p.parent.name}" for p in root.rglob("*.parquet")}
    assert named <= on_disk and len(on_disk) <= len(named) + 40  # those of the pointer before stay


def test_store_leaves_nothing_behind(spark, tmp_path):
    root = tmp_path / "v"
    store = stores.ParquetVectorStore(spark, str(root), buckets=2, most_changes=2, grace=0)
    rows = spark.createDataFrame([(f"h{i:03}", f"t{i}", 100, "a", {}, 0, i) for i in range(30)], CHUNK)
    sync.sync(rows, spark.createDataFrame([], "content_hash string"), store, stores.HashEmbedder(8), stage_size=2)
    assert store.count() == 30 and not list(root.glob("staged-*"))
    assert len(list(root.glob("g0*"))) <= 8
    (root / "staged-lost").mkdir()
    slow = stores.ParquetVectorStore(spark, str(root), buckets=2, most_changes=2, grace=10_000)
    slow.upsert(store.vectors(spark).limit(1))
    assert (root / "staged-lost").exists()
    store.table.clean()
    assert not (root / "staged-lost").exists() and store.count() == 30
    reader = slow.vectors(spark)  # a reader that began before later writes still finds its files
    for _ in range(4):
        slow.upsert(slow.vectors(spark).limit(1))
    assert reader.count() == 30


def test_upload(spark):
    def put(key, text, facts):
        if key == "h1":
            raise OSError("no")

    rows = spark.createDataFrame([(f"h{i % 4}", "t", f"p{i}", "r", "c") for i in range(8)], "content_hash string, content string, doc_path string, source_repo string, commit_sha string")
    done = sync.upload(rows, put, spark.createDataFrame([("h0",)], "content_hash string"), base_ms=1)
    assert {r.content_hash: r.error for r in done.collect()} == {"h1": "no", "h2": None, "h3": None}
    with pytest.raises(RuntimeError):
        sync.upload_gate(done)
    assert sync.upload_gate(done.where("error is null")) == 2


def test_examples(spark, tmp_path):
    from docpipe import examples

    rows = spark.createDataFrame([(f"h{i}", f"t{i}", 40 + 700 * i, "a", "ctx", ["s"], "r", "c") for i in range(4)], "content_hash string, content string, token_count int, doc_path string, page_context string, section_path array<string>, source_repo string, commit_sha string")
    assert examples.embeddable(rows).count() == 2
    assert {r.label: r.chunks for r in examples.labelled_counts(rows).collect()} == {"too_small": 1, "embeddable": 2, "too_large": 1}
    assert examples.oversized_files(rows).first().oversized == 2
    assert examples.embed_into(rows, stores.HashEmbedder(4), stores.ParquetVectorStore(spark, str(tmp_path / "v"))) == 2
    assert examples.copy_texts(rows, lambda *a: None, rows.select("content_hash").limit(1)) == 3


def test_exports():
    import docpipe

    assert all(getattr(docpipe, n) is not None for n in docpipe.__all__)
    with pytest.raises(AttributeError):
        docpipe.nothing


def test_packs_and_paths(spark):
    from docpipe.operators.ranking import greedy_packs
    from docpipe.operators.sections import heading_paths

    rows = spark.createDataFrame([("a", i, n) for i, n in enumerate([5, 5, 1, 20, None, 3])] + [("b", 0, 30), (None, 0, 1)], "k string, i int, n int")
    got = {(r.k, r.i): r.pack for r in greedy_packs(rows.repartition(3), "k", "i", "n", 10).collect()}
    assert [got["a", i] for i in range(6)] == [0, 0, 1, 2, 3, 3] and got["b", 0] == 0 and got[None, 0] == 0
    heads = [(1, 2, "x"), (2, 1, "A"), (3, 3, "deep"), (4, 2, "B"), (5, 3, "C"), (6, 3, "D"), (7, 6, "E"), (8, 1, "F"), (9, 2, "G")]
    paths = heading_paths(spark.createDataFrame([("d", *h) for h in heads], "doc_path string, seq int, level int, heading string"))
    want, above = {}, []
    for seq, level, heading in heads:
        above = [a for a in above if a[0] < level] + [(level, heading)]
        want[seq] = [h for _, h in above]
    assert {r.seq: r.section_path for r in paths.collect()} == want


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_ranks(spark, kind):
    from docpipe.operators.ranking import with_rank

    rows = spark.range(999, -1, -1).repartition(5).select(F.concat(F.lit("doc"), "id").alias("k") if kind == "string" else F.col("id").alias("k"))
    got = [(r.k, r["rank"]) for r in with_rank(rows, "k").collect()]
    assert sorted(got, key=lambda x: x[1]) == [(k, i) for i, k in enumerate(sorted(k for k, _ in got))]
    assert with_rank(rows.limit(0), "k").count() == 0


def test_content_store(spark, tmp_path):
    store = stores.ParquetContentStore(spark, str(tmp_path / "c"))
    df = spark.createDataFrame([("h", "t", "a", "r", "s"), ("h", "t", "b", "r", "s"), ("i", "u", "a", "r", "s")], "content_hash string, content string, doc_path string, source_repo string, commit_sha string")
    assert store.upload(df) == 2 and store.upload(df) == 0


def test_writer_and_retry():
    calls = []

    def flaky(batch):
        calls.append(batch)
        if len(calls) < 3:
            raise OSError("later")

    w = sync.BatchWriter(flaky, size=2, sleep=lambda s: None)
    w.run(range(2))
    assert len(calls) == 3 and w.written == [0, 1]
    dead = sync.BatchWriter(lambda b: 1 / 0, size=1, sleep=lambda s: None)
    with pytest.raises(RuntimeError):
        dead.run(range(9))
    assert len(dead.failed) == C.BREAKER
    seen = []
    with pytest.raises(KeyError):
        sync.retry(lambda: seen.append(1) or {}["x"], sleep=lambda s: None, transient=lambda e: isinstance(e, OSError))
    assert len(seen) == 1


def test_state(tmp_path):
    path = str(tmp_path / "s.json")
    assert state.load_state(path) == state.SyncState()
    state.save_state(path, state.SyncState("c", {"b", "a"}, 2, "now"))
    assert state.load_state(path).indexed_hashes == {"a", "b"}
    open(path, "w").write("{broken")
    assert state.load_state(path) == state.SyncState() and any(".corrupt." in f for f in os.listdir(tmp_path))
    assert state.git_facts(str(tmp_path))["remote_url"] == "unknown"


def test_stream(spark, tmp_path):
    """Files that change, are renamed, lose their chunks and go between runs: the chunks are those of a full run."""
    root, work = tmp_path / "in", str(tmp_path / "work")
    (root / "sub").mkdir(parents=True)
    page = lambda word: f"# T\n{word} " + "word " * 100
    key = lambda r: (r.doc_path, r.chunk_seq, r.content)

    def go():
        ingest_folder(spark, str(root), work).awaitTermination()
        full, _ = pipeline.ingest(files.read_pages(spark, C.ScanConfig(str(root))).select("doc_path", "text"))
        got = latest_chunks(spark, work)
        assert sorted(map(key, got.collect())) == sorted(map(key, full.collect()))
        last = changes(spark, work)
        top = last.agg(F.max("run")).first()[0]
        return {r.doc_path: r.action for r in last.where(F.col("run") == top).collect()}, got.count()

    for name in ("a", "b", "sub/c", "d"):
        (root / f"{name}.md").write_text(page(name))
    assert go() == ({"a.md": "new", "b.md": "new", "sub/c.md": "new", "d.md": "new"}, 4)
    assert go()[1] == 4 and changes(spark, work).count() == 4
    (root / "a.md").write_text(page("second"))
    (root / "b.md").rename(root / "sub/b.md")
    (root / "d.md").write_text("no heading, no chunk")
    (root / "sub/c.md").unlink()
    assert go() == ({"a.md": "changed", "b.md": "removed", "sub/b.md": "new", "sub/c.md": "removed", "d.md": "changed"}, 2)
    (root / "sub/c.md").write_text(page("c"))  # back again, as it was
    assert go() == ({"sub/c.md": "new"}, 3)
    # A run that was lost after its listing: the next takes both.
    (root / "a.md").write_text(page("third"))
    take_listing(pipeline.file_hashes(files.read_pages(spark, C.ScanConfig(str(root)))), f"{work}/listings")
    (root / "a.md").write_text(page("second"))
    (root / "e.md").write_text(page("e"))
    assert go() == ({"e.md": "new"}, 4)
    for f in root.rglob("*.md"):
        f.unlink()
    assert go()[1] == 0


def test_changes_cost_no_python(spark, tmp_path, capsys):
    """Paths are compared by a join: no Python for each of them, and the same changes if a run is lost or done again."""
    listings, got = str(tmp_path / "listings"), []

    def write(found, number):
        found.explain()
        got.append(sorted(tuple(r) for r in found.collect()))
        if len(got) == 2:
            raise OSError("lost")

    def take(**files_now):
        take_listing(spark.createDataFrame(list(files_now.items()), "doc_path string, file_hash string"), listings)

    take(a="1", b="1", c="1")
    change_stream(spark, listings, str(tmp_path / "ck"), write).awaitTermination()
    take(a="2", c="1", d="1")
    take(a="2", b="1", c="3")
    with pytest.raises(Exception):  # noqa: B017
        change_stream(spark, listings, str(tmp_path / "ck"), write).awaitTermination()
    change_stream(spark, listings, str(tmp_path / "ck"), write).awaitTermination()
    assert "Python" not in (plan := capsys.readouterr().out) and "Pandas" not in plan and "Join" in plan
    assert got[0] == [(p, "new", "1", 0) for p in "abc"]
    assert got[1] == got[2] == [("a", "changed", "2", 2), ("c", "changed", "3", 2)]


class Lost(stores.ParquetVectorStore):
    """Its n-th upsert is lost."""

    at, n = 1, 0

    def upsert(self, rows):
        self.n += 1
        if self.n == self.at:
            raise OSError("lost between embed and save")
        super().upsert(rows)


def test_sync_as_a_stream(spark, tmp_path):
    chunks, root = str(tmp_path / "chunks"), str(tmp_path / "v")
    rows = spark.createDataFrame([(f"h{i:03}", f"t{i}", 100, "a", {"k": "v"}, 0, i) for i in range(40)], CHUNK)
    rows.repartition(4).write.parquet(f"{chunks}/batch=0")
    go = lambda store: sync_stream(spark, chunks, store, Counted(str(tmp_path)), str(tmp_path / "ck"), files=1).awaitTermination()
    lost = Lost(spark, root, buckets=4)
    lost.at = 2
    with pytest.raises(Exception, match="lost"):
        go(lost)
    assert 0 < lost.count() < 40 and len(list((tmp_path / "v").glob("staged-batch-*"))) == 1
    store = stores.ParquetVectorStore(spark, root, buckets=4)
    go(store)
    calls = lambda: (tmp_path / "calls").read_text().split()
    assert store.count() == 40 and len(calls()) == 40 == len(set(calls()))
    assert not list((tmp_path / "v").glob("staged-*"))
    more = spark.createDataFrame([("h001", "t1", 100, "b", {}, 0, 0), ("new", "n", 100, "b", {}, 0, 1), ("small", "s", 3, "b", {}, 0, 2)], CHUNK)
    more.write.parquet(f"{chunks}/batch=1")
    go(store)
    go(store)
    assert store.count() == 41 and calls().count("n") == 1 and len(calls()) == 41
    assert prune(spark, store, more) == 39 and {r.id for r in store.vectors(spark).collect()} == {"h001", "new"}
    spark.createDataFrame([("x", "bad", 100, "a", {}, 0, 0)], CHUNK).write.parquet(f"{chunks}/batch=2")
    with pytest.raises(Exception, match="embeddings failed"):
        sync_stream(spark, chunks, store, Failing(8), str(tmp_path / "ck")).awaitTermination()
    go(store)
    assert store.count() == 3


def test_specifications_stay_when_none_are_given(spark, tmp_path):
    pages = spark.createDataFrame([("a.md", "# A\n" + "word " * 90)], "doc_path string, text string")
    specs = fixtures_specs(spark)
    run = lambda s, **more: pipeline.run(spark, pages, s, str(tmp_path / "o"), **more).first()
    count = lambda: spark.read.parquet(str(tmp_path / "o/chunks")).where("doc_path like 'api-reference/%'").count()
    run(specs)
    n = count()
    assert n > 0
    r = run(None)
    assert count() == n and r.deleted == 0
    run(None, full=True)
    assert count() == n
    r = run(specs)
    assert count() == n and r.skipped == 2 and r.processed == 0
    run(specs.limit(0))
    assert count() == 0


def fixtures_specs(spark):
    text = json.dumps({"openapi": "3.0.0", "info": {"title": "T", "version": "1"}, "paths": {"/a": {"get": {"summary": "A", "description": "long " * 80, "responses": {"200": {"description": "ok"}}}}}})
    return spark.createDataFrame([("payments/p.json", text)], "path string, text string")


def test_sinks(spark, tmp_path):
    from docpipe.sources import sinks

    pages = spark.createDataFrame([("a/x.mdx", "é"), ("b.md", None), ("b.md", "")], "doc_path string, body string")
    assert sinks.write_pages(pages, str(tmp_path / "n")).where("error is null").count() == 2
    (tmp_path / "n/c.md").mkdir()
    bad = sinks.write_pages(spark.createDataFrame([("c.md", "x"), ("d.md", "y")], "doc_path string, body string"), str(tmp_path / "n"))
    assert {r.path: r.error is None for r in bad.collect()} == {"c.md": False, "d.md": True} and (tmp_path / "n/d.md").read_text() == "y"
    assert (tmp_path / "n/a/x.md").read_text() == "é" and (tmp_path / "n/b.md").read_text() == ""
    chunks = spark.createDataFrame([("b", 1, 'q"'), ("a", 0, "é")], "doc_path string, chunk_seq int, content string")
    sinks.write_json_export(chunks, str(tmp_path / "o.json"), {"stats": {"n": 2}})
    assert json.loads((tmp_path / "o.json").read_text())["stats"] == {"n": 2}
    assert [r.doc_path for r in sinks.read_json_export(spark, str(tmp_path / "o.json")).collect()] == ["a", "b"]


def test_mounted_folders_are_read_as_spark_reads_them(spark, tmp_path, monkeypatch):
    """Executors list and read; the same rows as Spark's reader gives, and not a task for every few files."""
    odd = ("a.json", "b c+d%20é.json", "x/y=1/z.json", "x/_skip/n.json", "x/_k=v/n.json", ".h/n.json", "x/.n.json", "e.json._COPYING_", "q.txt", "x/_metadata.json", "[1].json")
    for i, name in enumerate(odd):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"\xff\n" + bytes([65 + i]) * i)
    (tmp_path / "empty.json").write_bytes(b"")
    (tmp_path / "no").mkdir()
    for glob in ("*", "*.json", "*.{json,txt}", "?.json"):
        seen = []
        for mounted in (True, False):
            if not mounted:
                monkeypatch.setattr(files, "_local_folder", lambda *_: None)
            rows = files.read_texts(spark, str(tmp_path), glob)
            seen.append(sorted(map(tuple, rows.select("path", F.hex("text"), "size", "modified").collect())))
            monkeypatch.undo()
        assert seen[0] == seen[1] and seen[0], glob
    for i in range(600):
        (tmp_path / f"no/{i}.json").write_text("{}")
    assert files.read_texts(spark, f"file:{tmp_path}/no").rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert files.read_texts(spark, f"file://{tmp_path}/no").count() == 600


def test_json_export_is_one_document_of_lines(spark, tmp_path):
    """Read in splits, by its lines; other layouts as one value; no part is left beside the file."""
    from docpipe.sources import sinks

    path = tmp_path / "o.json"
    rows = spark.range(2000).selectExpr("concat('f', id % 7) AS doc_path", "id AS chunk_seq", "concat('{\n\"', id, '\"},\u2028]') AS content").repartition(9)
    sinks.write_json_export(rows, str(path), {"stats": {"n": 1}})
    want = sorted(map(tuple, rows.collect()))
    assert [tuple(r.values()) for r in json.loads(path.read_text())["chunks"]] == want
    assert len(path.read_text().splitlines()) >= 2002 and [p.name for p in tmp_path.iterdir() if "crc" not in p.name] == ["o.json"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        back = sinks.read_json_export(spark, str(path))
        assert back.rdd.getNumPartitions() > 3
        assert sorted(map(tuple, back.select("doc_path", "chunk_seq", "content").collect())) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name, text in {"a": '{"chunks": [\n{"x": [{"y": 1},\n{"y": 2}]},\n{"x": []}\n]}', "b": '{\n"chunks": [{"x": [{"y": 1}]},\n{"x": null}]\n}'}.items():
        (tmp_path / name).write_text(text)
        assert sinks.read_json_export(spark, str(tmp_path / name)).count() == 2
    sinks.write_json_export(rows.limit(0), str(path), {})
    assert json.loads(path.read_text()) == {"chunks": []}


def test_counters(spark):
    from docpipe.functions import tokens
    from docpipe.operators.chunking import chunk_documents

    try:
        import public_tokenizers

        bpe = tokens.BpeCounter(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    except ImportError:
        pytest.skip("no vocabulary file here")
    assert bpe("hello world <|endoftext|>") > 3 and tokens.RegexCounter()("a b") == 2
    df = spark.createDataFrame([("p", 0, "s", ["s"], "word " * 3000)], "doc_path string, seq int, section string, section_path array<string>, content string")
    got = chunk_documents(df, count=bpe).collect()
    assert len(got) > 3 and all(r.token_count == bpe(r.content) for r in got[1:-1])
    assert df.select(tokens.count_udf(bpe, F.col("content")).alias("n")).first().n == bpe("word " * 3000)


def test_patient_embedder():
    class Busy(stores.HashEmbedder):
        left = 3

        def embed(self, text):
            self.left -= 1
            if self.left >= 0:
                error = RuntimeError("slow down")
                error.status = 429
                raise error
            return super().embed(text)

    waits = []
    e = stores.PatientEmbedder(Busy(4), gap_ms=100, sleep=waits.append, share=lambda: 1.0)
    assert e.embed("a") == stores.HashEmbedder(4).embed("a") and e.calls == 4
    assert waits == [1.0, 0.1, 2.0, 0.1, 4.0, 0.1]
    broken = stores.PatientEmbedder(Failing(4), sleep=waits.append)
    with pytest.raises(RuntimeError):
        broken.embed("bad")
    assert broken.calls == 1


def test_sync_plan_moves_texts_once(spark):
    """Plan and first rows come from one aggregate; stages are ranges of hashes, each of its size, and need no shuffle of texts."""
    rows = [(f"h{i % 70:02d}", f"t{i}", {"m": str(i)}, i, 0) for i in range(140)] + [(None, "x", None, 1, 1)]
    wanted = spark.createDataFrame(rows, "content_hash string, content string, metadata map<string,string>, file_seq int, chunk_seq int")
    state = spark.createDataFrame([("h03",), ("h03",), ("old",), (None,)], "content_hash string")
    plan = sync.planned(wanted, state)
    assert plan._jdf.queryExecution().toString().split("== Physical Plan ==")[1].count("Exchange hashpartitioning") <= 1
    got = {r.content_hash: (r.op, r.content) for r in plan.collect()}
    assert len(got) == 71 and got["h03"] == ("update", "t3") and got["old"] == ("delete", None) and got["h69"] == ("insert", "t69")
    fresh = plan.where("op = 'insert'").persist()
    ranges = sync.stage_ranges(fresh, 69, 20)
    assert [fresh.where(c).count() for c in ranges] == [20, 20, 20, 9]
    assert [h for c in ranges for h in sorted(r[0] for r in fresh.where(c).collect())] == sorted(h for h, (op, _) in got.items() if op == "insert")
    assert not any("Exchange" in fresh.where(c)._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0] for c in ranges)
    assert sync.stage_ranges(fresh, 0, 20) == [] and len(sync.stage_ranges(fresh, 69, 69)) == 1


def test_token_count_is_computed_once(spark):
    from docpipe.functions import text as T
    from docpipe.operators.filters import should_embed

    texts = [("w " * 49, "a"), ("w " * 50, "a"), ("w " * 1600, "a"), ("w " * 1601, "a"), ("w " * 1601, C.FORCE_PREFIXES[0])]
    rows = spark.createDataFrame(texts, "text string, doc_path string")
    kept = rows.withColumn("token_count", T.token_count(F.col("text"))).where(should_embed(F.col("token_count"), F.col("doc_path")))
    assert kept.select("doc_path")._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert sorted(r.token_count for r in kept.collect()) == [50, 1600, 1601]


def test_empty_files_are_files(spark, tmp_path, monkeypatch):
    """Both readers list them: an empty page is a page, and a page that became empty has no chunks any more."""
    (tmp_path / "in/d/_skip").mkdir(parents=True)
    for name in ("e.md", "d/e.md", "d/_skip/e.md", "d/.e.md", "e.txt"):
        (tmp_path / "in" / name).write_text("")
    (tmp_path / "in/a.md").write_text("# A\n" + "word " * 90)
    for mounted in (True, False):
        if not mounted:
            monkeypatch.setattr(files, "_local_folder", lambda *_: None)
        found = files.read_texts(spark, str(tmp_path / "in"), "*.md").orderBy("path").collect()
        assert [(r.path, r.text == "", r.size) for r in found] == [("a.md", False, 454), ("d/e.md", True, 0), ("e.md", True, 0)]
        assert found[2].modified.timestamp() == int(os.path.getmtime(tmp_path / "in/e.md") * 1000) / 1000
    monkeypatch.undo()
    run = lambda: pipeline.run(spark, files.read_pages(spark, C.ScanConfig(str(tmp_path / "in"))).select("doc_path", "text"), None, str(tmp_path / "o")).first()
    assert (run().processed, run().skipped) == (3, 3)
    (tmp_path / "in/a.md").write_text("")
    last = run()
    assert (last.processed, last.skipped, last.deleted, last.chunks) == (1, 2, 0, 0)


def test_chunks_are_judged_before_they_are_cleaned(spark, capsys):
    """What cleaning leaves is blank only of blank texts; a plan without content does not clean."""
    from docpipe.functions import text as T

    texts = ["", " ", "\n\n", " ﻿\n\n ", "a", ".", " . \n\n.", "```\n```", "\n\n``````", "__CODE_BLOCK_0__", "a.\n\na.\n\nA.", "\u0085", "\x1f", "!?.", "``` ", " x"]
    chunk = lambda i, t: (i, "s", ["s"], t, 1)
    rows = [(str(i), [chunk(0, "x"), chunk(1, t)]) for i, t in enumerate(texts)]
    pages = spark.createDataFrame(rows, "doc_path string, chunks array<struct<chunk_seq:int,section:string,section_path:array<string>,content:string,token_count:int>>")
    good, failed = pipeline.clean_chunks(pages)
    clean = [r[0] for r in spark.createDataFrame(list(enumerate(texts)), "i long, t string").coalesce(1).select(T.clean_content(F.col("t"))).collect()]
    bad = {str(i) for i, t in enumerate(clean) if not t.strip(" \n ﻿")}
    assert bad == {"0", "1", "2", "3"} == {r.doc_path for r in failed.collect()}
    assert {(r.doc_path, r.content) for r in good.where("chunk_seq = 1").collect()} == {(str(i), t) for i, t in enumerate(clean) if str(i) not in bad}
    good.select("doc_path", "chunk_seq").explain()
    assert "CODE_BLOCK" not in capsys.readouterr().out
