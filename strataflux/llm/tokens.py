"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: where the vocabulary file lies on every node; it is read, never copied
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: fixed value: the pattern that splits text before the merges of this vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoding(vocabulary: str):  # noqa: ANN201
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of a text; 0 for a null or empty one."""

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoding(vocabulary).encode_ordinary
        for texts in batches:
            yield pd.Series([len(encode(x)) if x else 0 for x in texts], dtype="int32")

    return count(text)


def numbered_copies(sizes: DataFrame, columns: list[str]) -> DataFrame:
    """The rows with `copy`, 1 and up, over rows that are equal in `columns`; counted before they travel. A hash that takes
    the copy in spreads equal rows, and doesn't depend on how the table is split."""
    counted = sizes.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    return counted.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"))
