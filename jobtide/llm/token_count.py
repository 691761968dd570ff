"""Token counts by heap-and-linked-list byte-pair merging.

The count of a piece is its initial symbols minus the merges made; no id is ever produced. Texts are
counted unit by unit with a bounded memo in each worker, so that memory does not follow the input.
No shuffle: a row's count depends on its own text only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm import bpe
from jobtide.llm.common import present


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row its id, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more tokens than the limit).

    Null and empty texts have no bytes and no tokens. Repeated rows and ids, null ids among them, each
    keep a row. An empty table gives none. Other columns, whatever their names, are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = bpe.loaded(bpe.Counter, tokenizer)
        for batch in batches:
            texts = batch.column(1)
            tokens = [counter.count(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(tokens, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    text = present(text_column)
    rows = docs.select(
        F.col(id_column).alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long").select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
