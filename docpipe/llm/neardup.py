"""MinHash near-duplicates by a signature-coordinate inverted join.

1. Each document's set of word shingles gives a signature of K coordinates.
   Documents with equal sets form one class, represented by its least doc_id.
2. Classes are posted under each (coordinate, value) pair. A pair of classes of
   similarity s shares each coordinate with probability s, so linked pairs share
   at least `matches` of K but for a chance of 5.0 in a million at s = 0.8.
   Values that occur once are skipped; with the values of a class ordered from
   rare to frequent, any two classes with that many matches meet in their first
   K - matches + 1 values, so only that prefix is posted.
3. Collisions of each posting with the least member of its list are counted per
   pair; pairs whose signatures match often enough are confirmed on full sets.
   That is linear in the postings, and joins most of every group.
4. Lists whose members are in one component now are skipped. In the others, of up
   to FEW members, the collisions of members of different components are counted
   per pair and confirmed in the same way: every posting meets fewer than FEW.
5. Longer lists that are still in several components are merged into clusters. A
   cluster is cut by hash into blocks of bounded bytes; each pair of blocks is one
   task that counts coordinate matches, confirms pairs on full shingle sets, skips
   pairs that are connected already, and returns only a spanning forest.
6. The components of all links are the result.

Defined cases: null text, empty text and text without words have an empty set
and are linked with nothing; a null doc_id is linked with nothing and kept. Rows
of one doc_id with different texts are one vertex for near_duplicates (they have
one component_id), and texts of their own for keep_first, which keeps one text of
every group of texts. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from . import _text as X
from ._store import Scratch
from .graph import components

K, MATCHES = 40, 20
FEW = 32
BLOCK_BYTES = 512 << 10  # of a small cluster
MOST_SMALL_BLOCKS = 16
LARGE_BLOCK_BYTES = 8 << 20  # of a cluster that would have more blocks than that

_SETS = "doc_id long, tag long, n_shingles long, set_hi long, set_lo long, sig array<int>"


def _shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    texts = [t.translate(X.SPACE_FOLD) for t in X.text_bytes(column)]
    hashed, _, _, first = X.word_table(texts)
    shingles, first = X.shingle_table(hashed, first, width, short=True)
    return [np.unique(shingles[a:b]) for a, b in zip(first, first[1:])]


def signatures(sets: list[np.ndarray], k: int = K) -> np.ndarray:
    """Rows of k int32 min-hash coordinates; zeros for an empty set."""
    out = np.zeros((len(sets), k), np.int32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        at = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
        values = np.concatenate([sets[i] for i in full])
        for j, m in enumerate(X.seeds(k, 5)):
            least = np.minimum.reduceat((values * m) >> np.uint64(32), at)
            out[full, j] = least.astype(np.uint32).view(np.int32)
    return out


def _signature_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text"):
            sets = _shingle_sets(batch.column("text"), width)
            digest = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64)
            digest = digest.reshape(-1, 2)
            sig = signatures(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("tag"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digest[:, 0]),
                    pa.array(digest[:, 1]),
                    X.list_array(sig.ravel(), np.arange(len(sets) + 1) * K, pa.int32()),
                ],
                names=["doc_id", "tag", "n_shingles", "set_hi", "set_lo", "sig"],
            )

    return run


def _member_rows(width: int):
    """(cluster, blocks, v, root, sig, members) of candidate classes, with their full sets as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text"):
            sets = _shingle_sets(batch.column("text"), width)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("cluster", "blocks", "v", "root")),
                    pa.array([s.tobytes() for s in signatures(sets)], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                names=["cluster", "blocks", "v", "root", "sig", "members"],
            )

    return run


def _confirmed(width: int, percent: int):
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text_a"):
            first, second = (_shingle_sets(batch.column(c), width) for c in ("text_a", "text_b"))
            common = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(first, second)]
            linked = [100 * n >= percent * (len(x) + len(y) - n) for n, x, y in zip(common, first, second)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def link_forest(
    ids: np.ndarray, side: np.ndarray, sig: np.ndarray, sets: list[np.ndarray], percent: int, both: bool, group: np.ndarray
) -> list[tuple[int, int]]:
    """A spanning forest of the links among rows (both: only between side 0 and side 1), beyond those inside groups.

    Each row is compared with all later ones that are not in its component yet:
    signature matches first, then the exact intersection of the full sets.
    """
    n = len(ids)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    values = np.concatenate(sets)
    _, local = np.unique(values, return_inverse=True)
    at = np.zeros(n + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    mark = np.zeros(int(local.max()) + 1 if len(local) else 0, np.int32)
    group = group.copy()
    edges = []
    for i in range(n - 1):
        other = np.flatnonzero(group[i + 1 :] != group[i]) + i + 1
        if both:
            other = other[side[other] != side[i]]
        other = other[100 * np.minimum(sizes[other], sizes[i]) >= percent * np.maximum(sizes[other], sizes[i])]
        other = other[(sig[other] == sig[i]).sum(1) >= MATCHES]
        if not len(other):
            continue
        mine = local[at[i] : at[i + 1]]
        mark[mine] = 1
        step = max(1, (1 << 22) // max(1, int(sizes[other].max())))
        for part in (other[p : p + step] for p in range(0, len(other), step)):
            lengths = sizes[part]
            begin = np.cumsum(lengths) - lengths
            where = np.arange(int(lengths.sum())) - np.repeat(begin - at[part], lengths)
            common = np.add.reduceat(mark[local[where]], begin)
            for j in part[100 * common >= percent * (sizes[i] + lengths - common)]:
                if group[j] != group[i]:
                    edges.append((int(ids[i]), int(ids[j])))
                    group[group == group[j]] = group[i]
        mark[mine] = 0
    return edges


def _block_links(percent: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        ids = table.column("v").to_numpy()
        order = np.argsort(ids, kind="stable")
        side = (table.column("block").to_numpy()[order] != low).astype(np.int8)
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.int32).reshape(-1, K)[order]
        members = table.column("members").to_pylist()
        sets = [np.frombuffer(members[i], np.uint64) for i in order]
        edges = link_forest(ids[order], side, sig, sets, percent, low != high, table.column("root").to_numpy()[order])
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return run


def _class_links(docs: DataFrame, width: int, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their set digest, classes of equal sets with a vertex v, and links (a, b) of vertices."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("tag", F.xxhash64("text"))
    base = scratch.save(texts.mapInArrow(_signature_rows(width), _SETS))
    full = base.where("n_shingles > 0 and doc_id is not null")
    classes = scratch.save(
        full.groupBy("set_hi", "set_lo").agg(
            F.min("doc_id").alias("rep"), F.min_by("tag", "doc_id").alias("tag"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles")
        )
    )
    clashes = classes.groupBy("rep").agg(F.count("*").alias("n")).where("n > 1").select("rep", F.lit(True).alias("clash"))
    if clashes.isEmpty():
        classes = classes.withColumn("v", F.col("rep"))
    else:  # a doc_id that is the least of several sets: each has a vertex of its own
        own = F.xxhash64("set_hi", "set_lo")
        classes = scratch.save(classes.join(clashes, "rep", "left").withColumn("v", F.when(F.col("clash"), own).otherwise(F.col("rep"))).drop("clash"))
    if not base.groupBy("doc_id", "tag").count().where("count > 1").isEmpty():
        texts = texts.dropDuplicates(["doc_id", "tag"])
    texts = texts.withColumnRenamed("doc_id", "rep")
    at = classes.select("v", "rep", "tag")

    posted = classes.select("v", F.posexplode("sig").alias("at", "value")).select(
        "v", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("value").cast("long")).alias("token")
    )
    frequency = posted.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    ordered = (
        posted.join(frequency, "token")
        .groupBy("v")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
        .where(F.size("shared") >= MATCHES)
    )
    first = F.slice("shared", F.lit(1), F.size("shared") - MATCHES + 1)
    prefix = scratch.save(ordered.select("v", F.explode(first).alias("p")).select("v", F.col("p.token").alias("token")))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The links among pairs with a count of collisions in their prefixes."""
        for c in "ab":
            side = classes.select(F.col("v").alias(c), F.col("sig").alias(f"sig_{c}"), F.col("n_shingles").alias(f"n_{c}"))
            pairs = pairs.join(side, c)
        equal = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
        sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
        pairs = scratch.save(pairs.where(sizes).where(equal >= MATCHES).select("a", "b"))
        found = pairs
        for c in "ab":
            named = texts.join(at.withColumnRenamed("v", c), ["rep", "tag"]).select(c, F.col("text").alias(f"text_{c}"))
            found = found.join(named, c)
        found = scratch.save(found.mapInArrow(_confirmed(width, percent), "a long, b long"))
        scratch.drop(pairs)
        return found

    lists = prefix.groupBy("token").agg(F.min("v").alias("a"), F.max("v").alias("last")).where("a < last")
    star = prefix.join(lists, "token").where("v > a").groupBy("a", F.col("v").alias("b")).agg(F.count("*").alias("n"))
    root = components(confirmed(star), scratch)
    links = root.select(F.col("v").alias("a"), F.col("root").alias("b"))
    held = scratch.save(prefix.join(root, "v", "left").select("v", "token", F.coalesce("root", "v").alias("root")))
    scratch.drop(prefix)
    open_lists = held.groupBy("token").agg(F.count("*").alias("n"), F.min("root").alias("r"), F.max("root").alias("s")).where("r < s")
    held = scratch.save(held.join(open_lists.select("token", "n"), "token"))
    few = held.where(F.col("n") <= FEW)
    one, other = (few.select("token", F.col("v").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
    met = one.join(other, "token").where("a < b and root_a <> root_b").groupBy("a", "b").agg(F.count("*").alias("n"))
    links = links.unionByName(confirmed(met))
    links = links.unionByName(_hot_links(held.where(F.col("n") > FEW), classes, texts, width, percent, scratch))
    scratch.drop(held)
    return base, classes, links


def _hot_links(held: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links among the members of long lists, by pairs of blocks of their clusters."""
    pivot = held.groupBy("token").agg(F.min("v").alias("b"))
    cluster = components(held.join(pivot, "token").select(F.col("v").alias("a"), "b"), scratch)
    sized = cluster.withColumnRenamed("root", "cluster").join(held.groupBy("v").agg(F.first("root").alias("root")), "v")
    sized = sized.join(classes.select("v", "rep", "tag", (F.col("n_shingles") * 8 + 400).alias("bytes")), "v")
    sized = scratch.save(sized)
    small, large = (F.ceil(F.col("bytes") / F.lit(b)) for b in (BLOCK_BYTES, LARGE_BLOCK_BYTES))
    total = (
        sized.groupBy("cluster")
        .agg(F.sum("bytes").alias("bytes"))
        .select("cluster", F.greatest(F.least(small, F.lit(MOST_SMALL_BLOCKS)), large).cast("int").alias("blocks"))
    )
    candidates = scratch.save(sized.join(total, "cluster").select("cluster", "blocks", "v", "root", "rep", "tag"))
    members = texts.join(candidates, ["rep", "tag"]).select("cluster", "blocks", "v", "root", "text")
    members = members.mapInArrow(_member_rows(width), "cluster long, blocks int, v long, root long, sig binary, members binary")
    members = members.withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    paired = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.select(
        "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "v", "root", "sig", "members"
    )
    links = scratch.save(paired.groupBy("cluster", "low", "high").applyInArrow(_block_links(percent), "a long, b long"))
    scratch.drop(sized, candidates)
    return links


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "neardup")
    base, classes, links = _class_links(docs, width, percent, scratch)
    sets = base.where("n_shingles > 0 and doc_id is not null").select("doc_id", "set_hi", "set_lo").distinct()
    several = sets.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not several.isEmpty():  # the sets of one doc_id are one vertex
        own = scratch.save(sets.join(several, "doc_id").join(classes, ["set_hi", "set_lo"]).select("doc_id", F.col("v").alias("a")))
        links = links.unionByName(own.join(own.groupBy("doc_id").agg(F.min("a").alias("b")), "doc_id").select("a", "b"))
    component = components(links, scratch)
    named = classes.select("set_hi", "set_lo", "rep", "v").join(component, "v", "left").withColumn("root", F.coalesce("root", "v"))
    named = scratch.save(named.select("set_hi", "set_lo", "rep", "root"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "root").select("set_hi", "set_lo", "component_id")
    out = base.select("doc_id", "n_shingles", "set_hi", "set_lo").join(named, ["set_hi", "set_lo"], "left")
    out = out.withColumn("component_id", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")))
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = scratch.save(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
    scratch.clear(out)
    return out


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, with all their columns, that stand for their group of texts.

    Every text that goes has a path of links to one that stays, whatever ids the
    rows have. Rows that repeat a doc_id and its text are one document, of which
    one stays. Rows with a null doc_id stay, and those without words.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "kept")
    base, classes, links = _class_links(docs, width, percent, scratch)
    component = components(links, scratch)
    first = classes.select("set_hi", "set_lo", "v", "rep", F.col("tag").alias("rep_tag")).join(component, "v", "left")
    first = first.select("set_hi", "set_lo", "rep", "rep_tag", F.coalesce(F.col("root") == F.col("v"), F.lit(True)).alias("stands"))
    rows = base.where("n_shingles > 0 and doc_id is not null").join(first, ["set_hi", "set_lo"])
    gone = rows.where("not (stands and doc_id = rep and tag = rep_tag)").select(F.col("doc_id").alias("__llm_id"), F.col("tag").alias("__llm_tag"))
    several = base.where("doc_id is not null").groupBy(F.col("doc_id").alias("__llm_id"), F.col("tag").alias("__llm_tag")).count()
    several = scratch.save(several.where("count > 1").drop("count").join(gone, ["__llm_id", "__llm_tag"], "left_anti"))
    gone = scratch.save(gone)
    scratch.clear(gone, several)

    def among(table: DataFrame, how: str) -> DataFrame:
        same = (docs["doc_id"].cast("long") == table["__llm_id"]) & (F.xxhash64(docs["text"].cast("string")) == table["__llm_tag"])
        return docs.join(table, same, how)

    if several.isEmpty():
        return among(gone, "left_anti")
    out = among(gone.unionByName(several), "left_anti")
    row = F.first(F.struct(*(F.col(c) for c in docs.columns))).alias("__llm_row")
    again = among(several, "left_semi").groupBy(F.col("doc_id").cast("long").alias("__llm_id"), F.col("text").cast("string").alias("__llm_text"))
    return out.unionByName(again.agg(row).select("__llm_row.*"))
