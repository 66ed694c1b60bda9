from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = ["an", "ti", "er", "the", "on", "sh", "ou", "re", "ble", "wh", "ed", "ing", "lo", "ma"]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    out = []
    for i in range(words):
        w = "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3)))
        out.append(w.capitalize() + "." if i % 9 == 8 else w)
    return " ".join(out)


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows(start: int = 1000):
    """Null and empty texts, blanks, a null id, a very long text, repeated rows, odd characters."""
    return [
        (start, None),
        (start + 1, ""),
        (start + 2, " \n\t "),
        (None, prose(5, 80)),
        (None, None),
        (start + 3, prose(6, 60_000)),
        (start + 4, prose(7, 100)),
        (start + 4, prose(7, 100)),
        (start + 5, "日本語 😀 \u00a0 \ufeff é ß İ " * 30),
        (start + 6, "a " * 3000),
        (start + 7, "x"),
    ]


def with_clashes(df):
    """Extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    names = ("rep", "token", "cluster", "kept", "score", "y", "hash", "windows", "row", "rank", "piece", "count", "label", "key", "whole", "stats", "tag", "v", "root", "spotted", "bits", "live", "origin", "slot", "base", "x", "found", "w", "group", "low", "n", "s", "dim")
    return df.select("*", *(F.lit(i).alias(n) for i, n in enumerate(names)))
