"""Token counts of whole texts: Arrow functions that return lengths only.

Each Arrow batch is cut into slices balanced by bytes; texts are split at safe
boundaries (see codec.py), and the distinct pieces go to the tokenizers
library in batches. No ids leave the worker.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
each get a row, and so do rows without a doc_id; an empty table gives an empty table; other columns never matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .codec import GROUP_BYTES, codec
from .shared import small_batches
from .text import Texts, grouped

LIMIT = 2048


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(spark: SparkSession, docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row; vocabulary: path of the tokenizers file, the same on all executors."""
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grouped(batches, GROUP_BYTES):
            texts = Texts(part.column("text"))
            n = codec(vocabulary).lengths(texts)
            yield pa.record_batch({"doc_id": part.column("doc_id"), "n_bytes": pa.array(np.diff(texts.bounds)), "n_tokens": pa.array(n), "over_limit": pa.array(n > limit)})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path("word_bpe_49k.json"))
