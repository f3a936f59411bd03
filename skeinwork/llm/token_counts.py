"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batches_by_bytes, flat_bytes, id_and_text
from .tokens import piece_bpe_counts

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
_FIELDS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, batch_bytes: int = 4 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Rows are dealt into batches of about batch_bytes, so that a batch costs the same whatever the texts' lengths; a
    longer text is its own batch and is encoded piece by piece, cut where no token can cross. Null and empty texts have
    0 tokens. Repeated rows count each; no row needs another, so nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, batch_bytes):
            n = piece_bpe_counts(table["text"], model_path)
            size = np.diff(flat_bytes(table["text"])[1])
            yield pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), pa.array(size), pa.array(n), pa.array(n > limit)], schema=_FIELDS)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
