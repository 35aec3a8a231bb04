"""Problem 8: ids of whole texts under a public tokenizer."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from lectern.llm.bpe import encoder, ids_column, read_ranks

#: Where the public rank file lies; a parameter of every operator that needs it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def encode(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``key, ids``: the ids of each text, without special tokens; null and empty texts have the empty list.

    Strings that spell special tokens are ordinary text. Every row is kept, repeated keys too, and nothing is
    shuffled. The vocabulary is read on the driver and broadcast: it is a file of fixed size (here 0.8 MB).
    """
    tokens = df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, tokens.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), ids_column(b.column(1).to_pylist(), enc)], names=["key", "ids"])

    return df.select(key, text).mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)
