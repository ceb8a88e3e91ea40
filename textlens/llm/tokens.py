"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import sys
import types

import pandas as pd
from pyspark.sql import Column, functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The split pattern this vocabulary was made with (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(path: str = TOKENIZER):
    """The encoding of a rank file, loaded once in each worker process."""
    kept = sys.modules.setdefault("_textlens_tokenizers", types.ModuleType("_textlens_tokenizers"))
    if path not in kept.__dict__:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        kept.__dict__[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return kept.__dict__[path]


def n_tokens(text: Column, path: str = TOKENIZER) -> Column:
    """Number of tokens of each whole text; 0 for null and empty texts."""

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        encode = encoder(path).encode_ordinary
        return texts.map(lambda t: len(encode(t)) if t else 0).astype("int64")

    return count(text)
