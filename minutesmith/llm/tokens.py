"""Sizes of texts in tokens of a public tokenizer, whose file is a parameter and never part of this package."""

from __future__ import annotations

import base64
import os
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where the vocabulary lies; every executor must see it there.
VOCABULARY = os.environ.get("MINUTESMITH_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: How byte-pair tokenizers of this kind cut a text before merging.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def _encoding(path: str, split: str):  # noqa: ANN202
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("mine", pat_str=split, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: Column, vocabulary: str | None = None, split: str = SPLIT) -> Column:
    """Number of tokens of a string column; NULL and '' have none. A vocabulary that an executor does not find is an error."""
    path = vocabulary or VOCABULARY

    def f(s: pd.Series) -> pd.Series:
        encoding = _encoding(path, split)
        return pd.Series([len(encoding.encode_ordinary(t)) if t else 0 for t in s.tolist()], dtype="int64")

    return F.pandas_udf(f, "bigint")(text)
