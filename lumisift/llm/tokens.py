"""Token counts with public tokenizers; the vocabulary file is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import spread

#: Folder of the vocabulary files.
FOLDER = "/opt/tokenizers"
#: Default vocabulary, a byte-level BPE.
VOCABULARY = f"{FOLDER}/byte_bpe_50k.tiktoken"
# Fixed value: the pattern by which the byte-level vocabularies split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoder(path: str):
    """A function text -> token ids for a ``.tiktoken``, ``.json`` or ``.model`` file, loaded once per worker process."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path).encode
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """Number of tokens of the whole text, by Arrow batches; 0 for null and empty texts."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(path)
        for batch in batches:
            yield pd.Series([len(encode(t)) if t else 0 for t in batch], dtype="int64")

    return count(text)


def document_sizes(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id``, ``source`` and ``n_tokens`` of every row, whole texts; null and empty texts have 0. Rows without a doc_id are left out."""
    rows = spread(documents.select("doc_id", "source", "text").filter(F.col("doc_id").isNotNull()))
    return rows.select("doc_id", "source", token_count(F.col("text"), path).alias("n_tokens"))


def character_sizes(documents: DataFrame, per_token: int = 4) -> DataFrame:
    """:func:`document_sizes` by a rule that every engine has: one token per started ``per_token`` characters."""
    rows = documents.filter(F.col("doc_id").isNotNull())
    return rows.select("doc_id", "source", F.ceil(F.length(F.coalesce("text", F.lit(""))) / per_token).cast("bigint").alias("n_tokens"))
