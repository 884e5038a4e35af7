"""How long a text is: in code points, or in tokens of a named encoding."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(4)
def encoding(name: str, ranks: str | None = None, pattern: str | None = None):
    """A public encoding by name, or one built from a rank file; unknown names raise ValueError."""
    import tiktoken

    if ranks is None:
        return tiktoken.get_encoding(name)
    with open(ranks, "rb") as f:
        table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=table, special_tokens={})


def count_tokens(text: str, name: str, ranks: str | None = None, pattern: str | None = None) -> int:
    """Tokens of a text; strings of special tokens are ordinary text."""
    return len(encoding(name, ranks, pattern).encode_ordinary(text))


def token_length(text: Column, name: str, ranks: str | None = None, pattern: str | None = None) -> Column:
    @F.pandas_udf("int")
    def counted(texts: pd.Series) -> pd.Series:
        own = encoding(name, ranks, pattern)
        return texts.map(lambda t: len(own.encode_ordinary(t or "")))

    return counted(text)


def measure(text: Column, max_tokens: int, name: str, ranks: str | None = None, pattern: str | None = None) -> Column:
    """Tokens if a token limit is set, else code points."""
    return token_length(text, name, ranks, pattern) if max_tokens > 0 else F.char_length(text)
