"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Folder and name of the vocabulary; parameters everywhere below.
TOKENIZERS = os.environ.get("PAIRLOOM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: how byte_bpe_50k cuts a text into words before merging bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same in the faster standard engine, for texts without the characters that it classes otherwise.
_PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_OTHER = regex.compile(r"[\p{No}\p{Nl}\x1c-\x1f\x85᠎​]")


class Sizes(dict):
    """Tokens of each word met so far; forgets when it grows beyond ``most`` words."""

    def __init__(self, path: str, most: int = 500_000):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("sizes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        n = len(self.encoding.encode_ordinary(word))
        if len(word) <= 40:
            self[word] = n
        return n

    def count(self, text: str | None) -> int:
        if not text or text.isspace():
            return 0
        if not text.isascii() and _OTHER.search(text):
            return len(self.encoding.encode_ordinary(text))
        return sum(map(self.__getitem__, _PLAIN.findall(text)))


@lru_cache(maxsize=4)
def sizes(path: str) -> Sizes:
    """One counter for each Python worker and vocabulary."""
    return Sizes(path)


def token_count(text: Column, folder: str | None = None, vocabulary: str = VOCABULARY) -> Column:
    """Number of tokens of the whole text; 0 for null and blank texts."""
    path = os.path.join(folder or TOKENIZERS, vocabulary)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = sizes(path)
        for batch in batches:
            yield pd.Series([counter.count(t) for t in batch], dtype="int64")

    return F.pandas_udf(run, "bigint")(text)


