"""BPE encoding and decoding of whole texts (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm import word_bpe

ENCODED = "{key}, n_tokens long, ids binary, decoded string"


def encode_texts(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
                 decode: bool = True) -> DataFrame:
    """(key, n_tokens, ids, decoded) of every row.

    ``ids`` are little-endian unsigned 32-bit numbers; ``decoded`` is the text
    they decode to (null if not asked for). A null or empty text has no ids and
    decodes to ''. Repeated rows and null keys stay as they are; other columns
    are ignored, whatever their names; an empty table gives an empty one. Each
    row is handled on its own in the task that reads it, a few megabytes of text
    at a time, so there is no shuffle and a lost task is simply run again.
    """
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe.encoder(tokenizer)
        for batch in batches:
            texts = batch.column(1)
            for begin, end in word_bpe.slices(pa.compute.utf8_length(texts).fill_null(0).to_numpy(zero_copy_only=False)):
                flat, sizes = bpe.encode(texts.slice(begin, end - begin).to_pylist())
                ends = np.cumsum(sizes)
                rows = [flat[b:e] for b, e in zip(ends - sizes, ends)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, end - begin),
                    pa.array(sizes, pa.int64()),
                    pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary()),
                    pa.array([bpe.decode(r) if decode else None for r in rows], pa.string()),
                ], ["key", "n_tokens", "ids", "decoded"])

    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, ENCODED.format(key=f"key {key_type}")).withColumnRenamed("key", key))


def encoding_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Contract columns of the encoding query, from the operator's ids and texts."""
    return encode_texts(docs, tokenizer).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
