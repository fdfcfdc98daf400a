"""Packing by power-of-two decomposition.

A document of n ids is cut into pieces whose lengths are powers of two: as many pieces of the
longest length as fit, then the binary digits of the rest, longest first. Every piece is a
training sequence of its own, so no sequence crosses documents and none is padded; pieces of
equal length form a bucket from which batches are drawn.

Map-only: each task encodes its own rows, nothing is shuffled, and a piece's sequence_id is the
number of its input partition and its place there, which a task run again gives anew in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import field_type, longs, picked, strings
from cartlens.llm.tokens import Encoder, pack_ids

END_ID = 1
MAX_LENGTH = 2048


def piece_lengths(n: int, longest: int) -> list[int]:
    """Powers of two that add up to n, longest first, none above longest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def decompose(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    max_length: int = MAX_LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset, bucket (log2 of the length).

    A null text is an empty one and gives a single piece with the end id. Repeated rows are
    packed each for itself; a null doc_id is kept; an empty table gives no pieces; other columns
    of docs are left out.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    schema = (
        f"doc_id {field_type(docs, doc_id)}, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, bucket int"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, number = Encoder(tokenizer), pack_ids([end_id]), TaskContext.get().partitionId() << 33
        for batch in batches:
            row, start, length, tokens, ids = [], [], [], [], []
            for k, t in enumerate(strings(batch.column(1))):
                encoded = encoder.encode(t) + end
                n, at = len(encoded) // 4, 0
                for size in piece_lengths(n, max_length):
                    row.append(k)
                    start.append(at)
                    length.append(size)
                    tokens.append(n)
                    ids.append(encoded[4 * at : 4 * (at + size)])
                    at += size
            lengths = np.asarray(length, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    longs(start),
                    pa.array(lengths),
                    pa.array(ids, pa.binary()),
                    longs(tokens),
                    longs(np.arange(number, number + len(row))),
                    longs(np.zeros(len(row))),
                    pa.array(np.log2(np.maximum(lengths, 1)).astype(np.int32)),
                ],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "bucket"],
            )
            number += len(row)

    return picked(docs, doc_id=doc_id, text=text).mapInArrow(run, schema)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences of equal length in a folder each, from which fixed-shape batches are read."""
    pieces.write.partitionBy("bucket").parquet(path)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )
