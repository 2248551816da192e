"""Token counts by a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import os

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..runtime import reach_package

#: Where the vocabulary lies; a parameter of every operator that counts tokens.
VOCABULARY = os.environ.get("CHRONOFOLD_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: Fixed value: the pre-tokenization pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SHIPPED = "shipped:"
_loaded: dict[str, object] = {}


def encoding(path: str = VOCABULARY):
    """The tokenizer, loaded once a Python process."""
    if path not in _loaded:
        import tiktoken

        at = path
        if path.startswith(SHIPPED):
            from pyspark import SparkFiles

            at = SparkFiles.get(path.removeprefix(SHIPPED))
        with open(at, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def ship_vocabulary(spark: SparkSession, path: str = VOCABULARY) -> str:
    """Send the vocabulary file to all executors; the result is to be given as path."""
    spark.sparkContext.addFile(path)
    return f"{SHIPPED}{os.path.basename(path)}"


def token_count(text: Column | str, path: str = VOCABULARY) -> Column:
    """Number of tokens of the whole text; 0 for null and empty texts. Strings of special tokens count as ordinary text.

    The vocabulary is read from path on every executor; ship_vocabulary sends it there where the path isn't shared.
    """
    if (spark := SparkSession.getActiveSession()) is not None:
        reach_package(spark)

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        enc = encoding(path)
        return pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in texts], dtype="int32")

    return count(text)
