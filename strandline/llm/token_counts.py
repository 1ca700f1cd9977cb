"""Token counts: batches of about equal bytes are encoded in Arrow functions that return lengths only.

Texts are cut into units at safe places (see _tokens), so a giant text is encoded in pieces, and
about _tokens.BATCH_BYTES of text are worked on at a time, however many rows an Arrow batch has.
Python gives back lengths; texts are not sent back. Rows stay where the scan put them: nothing is
shuffled.

Defined cases: null and empty texts have 0 tokens and 0 bytes; repeated rows are counted row by row;
an empty table gives an empty result; columns named like result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm import _text, _tokens
from strandline.llm._shared import append_columns

LIMIT = 1024


def count(texts: pa.Array | list[str | None], path: str, batch_bytes: int = _tokens.BATCH_BYTES) -> np.ndarray:
    """Tokens of each text."""
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    return np.array([len(x) >> 2 for x in _tokens.encoded(column, path, batch_bytes)], np.int64)


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", limit: int = LIMIT, keep: Iterable[str] | None = None) -> DataFrame:
    """docs, or its columns in keep, with n_bytes, n_tokens and over_limit (n_tokens > limit)."""
    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]

    def lengths(batch: pa.RecordBatch) -> list[pa.Array]:
        column = batch.column(text_col)
        return [pa.array(np.diff(_text.strings(column)[1])), pa.array(count(column, path))]

    out = append_columns(docs, fields, lengths, keep)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def token_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_tokens, over_limit."""
    out = count_tokens(docs.select("doc_id", "text"), path or _tokens.tokenizer_path(), keep=["doc_id"])
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")
