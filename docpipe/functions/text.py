"""Text expressions as Column -> Column functions; all stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

# White space as ECMAScript has it: Java's \s, all Unicode separators, and the byte order mark.
WS = r"[\s\p{Z}\x{FEFF}]"
FENCE = r"(?s)```.*?```"
TOKEN = r"\p{L}+|\p{N}{1,3}|[^\s\p{L}\p{N}]"

# The patterns of instruction injection and their labels, in order.
INJECTION_PATTERNS = (
    (r"ignore\s+(all\s+)?(previous|prior|above|earlier)\s+instructions", "ignore-instructions"),
    (r"(disregard|forget|overlook)\s+(all\s+)?(previous|prior|earlier)\s+(instructions|guidance|rules)", "ignore-instructions"),
    (r"you\s+are\s+now", "role-override"),
    (r"(you'?re|you\s+will)\s+(now\s+)?(operating|acting|functioning)\s+as", "role-override"),
    (r"(pretend|act|behave)\s+(you\s+are|as\s+(if|though))", "role-override"),
    (r"system\s*prompt", "system-prompt-reference"),
    (r"(core|original|underlying)\s+(instructions|directive|rules)", "system-prompt-reference"),
    (r"<\|im_start\|>", "chat-template-injection"),
    (r"<\|(system|user|assistant)\|>", "chat-template-injection"),
    (r"\[INST\]", "instruction-template-injection"),
    (r"Human:\s*.{0,500}?\s*Assistant:", "conversation-injection"),
)


def trim_ws(c: Column) -> Column:
    """Trim all white space, not only blanks."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def collapse_ws(c: Column) -> Column:
    return F.regexp_replace(c, f"{WS}+", " ")


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def code_hash8(language: Column, code: Column) -> Column:
    return F.substring(F.md5(F.concat(F.coalesce(language, F.lit("")), F.lit(":"), trim_ws(code))), 1, 8)


def token_count(c: Column) -> Column:
    """The default token counter: letter runs, digits by three, single signs."""
    return F.coalesce(F.regexp_count(c, F.lit(TOKEN)), F.lit(0))


def public_url(path: Column, base: str) -> Column:
    clean = F.regexp_replace(F.regexp_replace(path, "^content/", ""), r"\.mdx?$", "")
    return F.concat(F.lit(base[:-1] if base.endswith("/") else base), F.lit("/"), clean)


def _segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def product_of(path: Column) -> Column:
    """Product named by a path; spec pages carry it one level deeper or in the file name."""
    parts = _segments(path)
    n = F.size(parts)
    name = F.get(parts, F.lit(2))
    dot = F.instr(name, ".")
    from_name = F.when(dot > 1, F.substring_index(name, ".", 1)).otherwise(F.regexp_replace(name, r"\.[^/.]+$", ""))
    spec = F.get(parts, F.lit(0)) == "api-reference"
    return (
        F.when(spec & (n >= 4), name)
        .when(spec & (n == 3), from_name)
        .when(n >= 2, F.get(parts, F.lit(1)))
        .otherwise(F.lit("general"))
    )


def category_of(path: Column) -> Column:
    parts = _segments(path)
    first = F.get(parts, F.lit(0))
    return (
        F.when((first == "api-reference") & (F.size(parts) >= 2), F.get(parts, F.lit(1)))
        .when(first.isin("payments", "data", "dev-tools"), first)
        .otherwise(F.lit("general"))
    )


def page_context(page_title: Column, sidebar_title: Column) -> Column:
    title = F.nullif(page_title, F.lit(""))
    side = F.when(~F.coalesce(sidebar_title == page_title, F.lit(False)), F.nullif(sidebar_title, F.lit("")))
    return F.coalesce(F.nullif(F.concat_ws(" | ", title, side), F.lit("")), F.lit("Documentation"))


def repo_name(url: Column) -> Column:
    bare = F.regexp_replace(url, r"\.git$", "")
    ssh = F.regexp_extract(bare, r"^git@[^:]*:(.+)$", 1)
    http = F.regexp_extract(bare, r"^https?://.*?([^/]+/[^/]+)$", 1)
    return F.coalesce(F.nullif(ssh, F.lit("")), F.nullif(http, F.lit("")), F.lit("unknown"))


def chunk_id(path: Column, section: Column) -> Column:
    return F.concat_ws("::", path, section)


def injection_labels(c: Column) -> Column:
    """Labels of the patterns that occur, in order and with repeats."""
    found = [F.when(F.coalesce(c, F.lit("")).rlike("(?is)" + p if p.startswith("Human") else "(?i)" + p), F.lit(label)) for p, label in INJECTION_PATTERNS]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, though body uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def keep_first(items: Column, key) -> Column:
    """Items of an array whose key did not occur before, in order; sorted by key, so not quadratic."""
    keyed = F.sort_array(F.transform(items, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x"))))

    def firsts(s: Column) -> Column:
        kept = F.filter(s, lambda e, i: (i == 0) | (F.get(s, i - 1)["k"] != e["k"]))
        return F.transform(F.sort_array(F.transform(kept, lambda e: F.struct(e["i"], e["x"]))), lambda e: e["x"])

    return let(keyed, firsts)


def _protected(c: Column, body) -> Column:
    """Apply body to the text with fenced code replaced by marks, then put the code back as it was."""
    mark = lambda i: F.concat(F.lit("__CODE_BLOCK_"), i.cast("string"), F.lit("__"))

    def hidden(fences: Column) -> Column:
        pieces = F.split(c, FENCE, -1)
        marked = F.array_join(F.transform(pieces, lambda p, i: F.when(i < F.size(fences), F.concat(p, mark(i))).otherwise(p)), "")
        numbered = F.transform(fences, lambda f, i: F.struct(f.alias("code"), mark(i).alias("mark")))
        return F.aggregate(numbered, let(marked, body), lambda text, f: F.replace(text, f["mark"], f["code"]))

    fenced = let(F.regexp_extract_all(c, F.lit(FENCE), F.lit(0)), hidden)
    return F.when(F.contains(c, F.lit("```")), fenced).otherwise(let(c, body))


def _norm_key(c: Column) -> Column:
    return F.lower(collapse_ws(c))


def sentence_dedupe(paragraph: Column) -> Column:
    """One line of the paragraph's sentences, each kept once."""
    line = trim_ws(collapse_ws(paragraph))
    parts = F.split(line, r"(?<=[.!?])\s+(?=[A-Z])|(?<=[.!?])$", -1)
    parts = F.filter(F.transform(parts, trim_ws), lambda s: s != "")
    return let(parts, lambda p: F.array_join(keep_first(p, _norm_key), " "))


def paragraph_dedupe(c: Column) -> Column:
    """Paragraphs kept once, sentences once inside each; fenced code is never touched."""

    def body(marked: Column) -> Column:
        parts = F.filter(F.transform(F.split(marked, "\n\n+", -1), trim_ws), lambda p: p != "")
        return let(parts, lambda p: F.array_join(F.transform(keep_first(p, _norm_key), sentence_dedupe), "\n\n"))

    return F.when(trim_ws(c) == "", c).otherwise(trim_ws(_protected(c, body)))


def whitespace_normalize(c: Column) -> Column:
    def body(marked: Column) -> Column:
        return trim_ws(F.regexp_replace(F.regexp_replace(marked, r"(?m)[ \t]+$", ""), "\n{3,}", "\n\n"))

    return F.when(c == "", c).otherwise(_protected(c, body))


def clean_content(c: Column) -> Column:
    return let(paragraph_dedupe(c), whitespace_normalize)


def overlap_tail(c: Column, least: int = 60, most: int = 100) -> Column:
    """Last sentences of a text that add up to the overlap range; none for short texts."""
    parts = F.reverse(F.split(c, r"(?<=[.!?])\s+", -1))
    counted = F.transform(parts, lambda s: F.struct(s.alias("s"), token_count(s).alias("n")))
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"), F.lit(False).alias("done"))

    def step(acc: Column, x: Column) -> Column:
        fits = ~acc["done"] & (acc["n"] + x["n"] <= most)
        total = F.when(fits, acc["n"] + x["n"]).otherwise(acc["n"])
        text = F.when(fits, F.concat(x["s"], F.lit(" "), acc["text"])).otherwise(acc["text"])
        return F.struct(text.alias("text"), total.alias("n"), (acc["done"] | ~fits | (total >= least)).alias("done"))

    return F.when(token_count(c) < 2 * least, F.lit("")).otherwise(trim_ws(F.aggregate(counted, start, step)["text"]))


def slug(operation: Column, method: Column, path: Column) -> Column:
    """File slug of an endpoint: its operation id, else method and path."""
    rules = ((r"([a-z])([A-Z])", "$1-$2"), ("[^a-zA-Z0-9-]", "-"), ("-+", "-"), ("^-|-$", ""))
    named = F.lower(reduce(lambda c, r: F.regexp_replace(c, *r), rules, operation))
    plain = reduce(lambda c, r: F.regexp_replace(c, *r), (("[^a-zA-Z0-9]", "-"), ("-+", "-"), ("^-|-$", "")), path)
    return F.when(F.coalesce(operation, F.lit("")) != "", named).otherwise(F.concat(F.lower(method), F.lit("-"), plain))


def rag_metadata(c: Column) -> Column:
    """Keys and values of the metadata list at the end of a page, the last of a key."""
    at = F.instr(c, "## RAG Metadata")
    lines = F.split(F.when(at > 0, F.substr(c, at)), "\n")
    pattern = r"^- ([a-z_]+):\s*(.+)$"
    pairs = F.transform(
        F.filter(lines, lambda s: s.rlike(pattern)),
        lambda s: F.struct(F.regexp_extract(s, pattern, 1).alias("key"), trim_ws(F.regexp_extract(s, pattern, 2)).alias("value")),
    )

    def last(found: Column) -> Column:
        keys = F.reverse(F.transform(found, lambda p: p["key"]))
        return let(keys, lambda ks: F.filter(found, lambda p, i: F.array_position(ks, p["key"]) == F.size(ks) - i))

    return F.coalesce(F.map_from_entries(let(pairs, last)), F.create_map().cast("map<string,string>"))


def is_forced(path: Column) -> Column:
    return reduce(lambda a, b: a | b, (path.startswith(p) for p in C.FORCE_PREFIXES))
