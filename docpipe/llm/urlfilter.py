"""URL verdicts from one trie over reversed host labels, then path.

A rule is (kind, host, path). Its host fits that host and every subdomain, so
hosts are walked label by label from the right; each node may hold rule paths,
which are walked by segment and may end inside a segment, as a rule fits when
the url's path starts with its path. The longest match wins: first the rule with
more host labels, then the longer path; of two equal rules, block wins.

Defined cases: a null url, or one without "://", has an empty host and path and
no rule; a url that no rule fits gets the default verdict; a null id is kept;
other columns are ignored. Rule sets above BROADCAST_CHARS are refused for the
trie and matched by joins on host suffixes instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from . import _text as X

BROADCAST_CHARS = 64 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)


@dataclass(frozen=True)
class Rule:
    kind: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) of a url."""
    if url is None:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    cut = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    rest = rest[:cut]
    slash = rest.find("/")
    return (rest.translate(_FOLD), "") if slash < 0 else (rest[:slash].translate(_FOLD), rest[slash:])


class Trie:
    """Host labels from the right; at a node, a second trie over path segments."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")) if rule.host else ():
                node = node.setdefault("hosts", {}).setdefault(label, {})
            *whole, last = rule.path.split("/")
            place = node.setdefault("paths", {})
            for segment in whole:
                place = place.setdefault("next", {}).setdefault(segment, {})
            # What follows the last slash may end inside the url's segment.
            held = place.setdefault("ends", {})
            if last not in held or rule.kind == "block":
                held[last] = rule

    @staticmethod
    def _deepest(place: dict, path: str) -> Rule | None:
        best = None
        segments = path.split("/")
        for i, segment in enumerate(segments):
            ends = place.get("ends")
            if ends:
                fits = [e for e in ends if segment.startswith(e)]
                if fits:
                    best = ends[max(fits, key=len)]
            following = place.get("next", {}).get(segment)
            if following is None or i == len(segments) - 1:
                return best
            place = following
        return best

    def match(self, host: str, path: str) -> Rule | None:
        node, best = self.root, None
        for label in [*reversed(host.split(".")), None]:
            if "paths" in node:
                best = self._deepest(node["paths"], path) or best
            if label is None or label not in node.get("hosts", {}):
                return best
            node = node["hosts"][label]
        return best


def _verdict_rows(trie, default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trie.value
        for batch in X.slices(batches, "url"):
            parts = [split_url(u) for u in batch.column("url").to_pylist()]
            rules = [tree.match(*p) if p[0] else None for p in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    pa.array([p[0] for p in parts], pa.string()),
                    pa.array([p[1] for p in parts], pa.string()),
                    pa.array([r.name if r else None for r in rules], pa.string()),
                    pa.array([r.kind if r else default for r in rules], pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    return run


def _joined(pages: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    """The same result for rule sets too large to broadcast: a join on host suffixes."""
    spark = pages.sparkSession
    table = spark.createDataFrame([(r.host, r.path, r.name, r.kind) for r in rules], "host string, path string, rule string, kind string")
    table = table.groupBy("host", "path", "rule").agg(F.max("kind").alias("kind"))
    rest = F.regexp_extract("url", r"(?s)^.*?://([^?#]*)", 1)
    plain = pages.withColumn("rest", F.coalesce(rest, F.lit("")))
    plain = plain.select(
        "page_id",
        F.translate(F.substring_index("rest", "/", 1), _UPPER, _LOWER).alias("host"),
        F.regexp_extract("rest", r"(?s)^[^/]*(/.*)$", 1).alias("path"),
        F.monotonically_increasing_id().alias("row"),
    )
    labels = F.split("host", r"\.")
    suffix = plain.where("host <> ''").select(
        "row", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("end")
    )
    fits = suffix.join(table.withColumnsRenamed({"host": "end", "path": "start"}), "end").where(F.col("path").startswith(F.col("start")))
    depth = F.struct(F.size(F.split("end", r"\.")), F.length("start"), "rule", "kind")
    best = fits.groupBy("row").agg(F.max(depth).alias("b")).select("row", "b.rule", F.col("b.kind").alias("verdict"))
    out = plain.join(best, "row", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def url_verdicts(pages: DataFrame, rules: Iterable[Rule] = RULES, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages (page_id, url)."""
    spark = pages.sparkSession
    ship(spark)
    rules = list(rules)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    if sum(len(r.name) for r in rules) > BROADCAST_CHARS:
        return _joined(rows, rules, default)
    trie = spark.sparkContext.broadcast(Trie(rules))
    return rows.mapInArrow(_verdict_rows(trie, default), "page_id long, host string, path string, rule string, verdict string")


URL_SQL = """
WITH cut AS (
  SELECT page_id,
         CASE WHEN url LIKE '%://%' THEN regexp_replace(substr(url, strpos(url, '://') + 3), '[?#](.|\\n)*$', '') ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         translate(CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, 1, strpos(rest, '/') - 1) ELSE rest END,
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
  FROM cut),
ruled AS (
  SELECT page_id, host, path,
         CASE WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/'
              WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
