"""Token counters: the default pattern, or a BPE vocabulary file that you supply.

A counter is a picklable text -> int object, so it can be given to the chunker
and to `count_udf`; the vocabulary is loaded once in each worker process.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..operators.chunking import regex_tokens

# Fixed value: how byte-level vocabularies of this family cut text into words.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_loaded: dict[str, object] = {}


@dataclass(frozen=True)
class RegexCounter:
    def __call__(self, text: str) -> int:
        return regex_tokens(text)


@dataclass(frozen=True)
class BpeCounter:
    """Counts with a file of `base64-piece rank` lines; text that looks like a special token is ordinary text."""

    path: str
    pattern: str = PATTERN

    def __call__(self, text: str) -> int:
        if self.path not in _loaded:
            import tiktoken

            with open(self.path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            _loaded[self.path] = tiktoken.Encoding("supplied", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return len(_loaded[self.path].encode_ordinary(text))


def count_udf(counter, column: Column) -> Column:
    """Arrow batch counts; null counts 0."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: counter(t) if t else 0).astype("int32")

    return F.pandas_udf(run, IntegerType())(column)
