"""Token ids on disk as compressed bit or byte planes.

Documents are put in ascending doc_id order over range partitions; each partition encodes its
documents and writes segments. A segment holds whole documents, about SEGMENT_IDS ids, in one
self-contained payload:

    magic "PLN1", plane kind (1 byte), block ids, ids, blocks (little-endian, see HEADER)
    chunk index: for each block and plane the compressed size (unsigned 32-bit)
    the planes, each compressed with zstandard, block after block

A block of ids is transposed into planes: byte planes put the k-th byte of all ids together, bit
planes the k-th bit. High planes of small ids are constant and vanish in compression. The container
is a Parquet table with one row per segment (shard, segment, place in the shard, doc ids and
lengths, payload): Spark's writer commits it atomically on any file system, and each row can be
read by itself, from any block, through the chunk index.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.llm.common import field_type, longs, picked, strings
from cartlens.llm.tokens import Encoder, pack_ids

END_ID = 2
BLOCK_IDS = 1 << 16
SEGMENT_IDS = 1 << 20
LEVEL = 3
MAGIC = b"PLN1"
HEADER = "<4sBIQI"


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block, lowest first."""
    parts = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [np.ascontiguousarray(parts[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(parts, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        parts = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        rows = [np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes]
        parts = np.packbits(np.stack(rows, axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(parts).view("<u4").ravel()


def write_segment(ids: np.ndarray, kind: str = "byte", block: int = BLOCK_IDS, level: int = LEVEL) -> bytes:
    import zstandard

    pack = zstandard.ZstdCompressor(level=level).compress
    planes = [pack(p) for at in range(0, len(ids), block) for p in to_planes(ids[at : at + block], kind)]
    blocks = -(-len(ids) // block)
    index = np.array([len(p) for p in planes], dtype="<u4").tobytes()
    return struct.pack(HEADER, MAGIC, kind == "bit", block, len(ids), blocks) + index + b"".join(planes)


def read_segment(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids [first, last) of a segment; only the blocks that hold them are decompressed."""
    import zstandard

    magic, is_bit, block, n, blocks = struct.unpack_from(HEADER, payload)
    if magic != MAGIC:
        raise ValueError("not a segment of bit-plane ids")
    kind, per = ("bit", 32) if is_bit else ("byte", 4)
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, "<u4")
    sizes = np.frombuffer(payload, "<u4", blocks * per, struct.calcsize(HEADER)).astype(np.int64)
    ends = struct.calcsize(HEADER) + 4 * blocks * per + np.cumsum(sizes)
    unpack, out = zstandard.ZstdDecompressor().decompress, []
    for b in range(first // block, -(-last // block)):
        planes = [unpack(payload[ends[k] - sizes[k] : ends[k]]) for k in range(b * per, (b + 1) * per)]
        out.append(from_planes(planes, min(block, n - b * block), kind))
    skip = first // block * block
    return np.concatenate(out)[first - skip : last - skip]


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    kind: str = "byte",
    segment_ids: int = SEGMENT_IDS,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode every whole text and write the ids in ascending doc_id order.

    Null ids come first and a null text counts as empty (its end id only). Rows of equal id are
    ordered by a hash of their text, which also lets the range partitions divide a repeated id.
    An empty table writes no segment. One shuffle, of id and text.
    """
    schema = (
        "shard int, segment int, shard_start bigint, n_ids bigint, "
        f"doc_ids array<{field_type(docs, doc_id)}>, lengths array<bigint>, payload binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, shard = Encoder(tokenizer), pack_ids([end_id]), TaskContext.get().partitionId()
        keys: list[pa.Array] = []
        ids: list[bytes] = []
        held, written, number = 0, 0, 0

        def segment() -> pa.RecordBatch:
            all_ids = np.frombuffer(b"".join(ids), "<u4")
            names = pa.concat_arrays(keys)
            lengths = longs([len(x) // 4 for x in ids])
            columns = [
                pa.array([shard], pa.int32()),
                pa.array([number], pa.int32()),
                longs([written]),
                longs([len(all_ids)]),
                pa.ListArray.from_arrays([0, len(names)], names),
                pa.ListArray.from_arrays([0, len(lengths)], lengths),
                pa.array([write_segment(all_ids, kind, block_ids)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(
                columns, ["shard", "segment", "shard_start", "n_ids", "doc_ids", "lengths", "payload"]
            )

        for batch in batches:
            for k, t in enumerate(strings(batch.column(1))):
                keys.append(batch.column(0).slice(k, 1))
                ids.append(encoder.encode(t) + end)
                held += len(ids[-1]) // 4
                if held >= segment_ids:
                    yield segment()
                    written, number = written + held, number + 1
                    keys, ids, held = [], [], 0
        if ids:
            yield segment()

    rows = picked(docs, doc_id=doc_id, text=text).withColumn("tie", F.xxhash64("text"))
    placed = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    placed.select("doc_id", "text").mapInArrow(run, schema).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the files: doc_id, start (ids of all documents before it), n_tokens, ids.

    Segments are decoded where they are read. Positions within a shard are in the files; the
    shards' totals, one row for each task that wrote, are added up here and joined.
    """
    stored = spark.read.parquet(path)
    shards = stored.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    before, starts = 0, []
    for r in shards:
        starts.append((r["shard"], before))
        before += r["n"]
    offsets = spark.createDataFrame(starts, "shard int, before bigint")
    kind = stored.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"shard int, doc_id {kind}, place bigint, n_tokens bigint, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard, first = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                names, lengths = batch.column(2)[k].values, batch.column(3)[k].values.to_numpy()
                ids = read_segment(batch.column(4)[k].as_py()).tobytes()
                ends = np.cumsum(lengths)
                cut = [ids[4 * (e - n) : 4 * e] for e, n in zip(ends, lengths)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lengths), shard, np.int32)),
                        names,
                        longs(first + ends - lengths),
                        longs(lengths),
                        pa.array(cut, pa.binary()),
                    ],
                    ["shard", "doc_id", "place", "n_tokens", "ids"],
                )

    segments = stored.select("shard", "shard_start", "doc_ids", "lengths", "payload")
    documents = segments.mapInArrow(run, schema)
    # one row per writing task, so the broadcast side does not grow with the documents
    return documents.join(F.broadcast(offsets), "shard").select(
        "doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids"
    )


def document_digests(read: DataFrame) -> DataFrame:
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
