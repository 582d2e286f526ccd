"""Token counts of whole texts: the library encodes batches of equal bytes, and only lengths come back."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .encode import encoder


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 1024, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of each row.

    A null text counts as empty (0 bytes, 0 tokens), a null key stays null, repeated rows are counted
    each, an empty table gives no rows and other columns play no part. ``tokenizer`` is a file that
    every worker can open. Long texts are cut at white space where a cut changes no token.
    """

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = encoder(tokenizer).lengths
        for part in parts:
            tokens = pa.array(lengths(part.column(1).to_pylist()), pa.int64())
            size = pc.coalesce(pc.cast(pc.binary_length(part.column(1)), pa.int64()), pa.scalar(0, pa.int64()))
            over = pc.greater(tokens, limit)
            yield pa.RecordBatch.from_arrays([part.column(0), size, tokens, over], [key, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(count, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
