"""Exact deduplication in two passes over Bloom filters.

Texts are equal when their SHA-256 after collapsing white space is equal. Pass one counts the
digests into the cells of a Bloom filter that saturates at two: each task counts its own rows, the
counts of a block of cells are added up in one place, and what remains is one bit per cell, set if
it was hit twice. Pass two tests every row: if one of its cells was hit once only, its text occurs
once and the row passes straight through. Only the others, possibly repeated, are shuffled and
counted exactly, so that a false positive costs a little time and never a wrong answer.

The filter has a fixed greatest size. More rows than it has room for are taken in several slices of
the digest range, one filter after the other, so the false positive rate does not depend on the
size of the table. The digests are written sorted within each file, so a slice reads its part only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import fresh, picked, whole_text
from cartlens.session import materialize, scratch_path

FILTER_BITS = 1 << 27
BITS_PER_ROW = 16
HASHES = 4
BLOCK_BITS = 1 << 16

# every run of white space that is not one space already
SPACES = r"[\t-\r][\x20\t-\r]*|\x20[\x20\t-\r]+"


def digest(text: str = "text") -> F.Column:
    """SHA-256 (binary) of the text with each run of white space as one space; null is empty."""
    return F.unhex(F.sha2(F.regexp_replace(whole_text(text), SPACES, " "), 256))


def _hash_pair() -> list[F.Column]:
    return [F.xxhash64("digest").alias("h1"), F.xxhash64("digest", F.lit(1)).alias("h2")]


def _cells(h1: np.ndarray, h2: np.ndarray, bits: int) -> np.ndarray:
    """HASHES cells per row, by double hashing; bits is a power of two."""
    a, b = h1.view(np.uint64), h2.view(np.uint64) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)[:, None]
    return ((a + steps * b) & np.uint64(bits - 1)).astype(np.int64)


def _pair(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("h1", "h2"))


def _filter_bits(rows: int, most: int) -> int:
    return min(most, max(BLOCK_BITS, 1 << math.ceil(math.log2(max(rows, 1) * BITS_PER_ROW))))


def filter_of(keys: DataFrame, bits: int, hits: int) -> bytes:
    """The cells that at least `hits` (1 or 2) of the keys fall into, as bits.

    keys: h1, h2. Each task sends the cells it has, two bytes each, grouped by block; a block's
    cells from all tasks meet in one group of BLOCK_BITS cells. The result has bits / 8 bytes,
    whatever the number of keys.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def blocks() -> Iterator[pa.RecordBatch]:
            cells, n = np.unique(np.concatenate(held), return_counts=True)
            edges = np.flatnonzero(np.diff(cells // BLOCK_BITS, prepend=-1))
            place = (cells % BLOCK_BITS).astype("<u2")
            parts = np.split(np.arange(len(cells)), edges[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((cells[edges] // BLOCK_BITS).astype(np.int32)),
                    pa.array([place[p].tobytes() for p in parts], pa.binary()),
                    pa.array([place[p[n[p] > 1]].tobytes() for p in parts], pa.binary()),
                ],
                ["block", "once", "twice"],
            )

        rows = 0
        for batch in batches:
            # distinct cells of a row count once
            cells = np.sort(_cells(*_pair(batch), bits), axis=0)
            again = np.vstack([np.zeros(cells.shape[1], bool), cells[1:] == cells[:-1]])
            held.append(cells[~again])
            rows += batch.num_rows
            if rows >= 1 << 20:
                yield from blocks()
                held, rows = [], 0
        if rows:
            yield from blocks()

    def merge(table: pa.Table) -> pa.Table:
        n = np.zeros(BLOCK_BITS, np.int32)
        for column in ("once", "twice"):
            for part in table.column(column):
                np.add.at(n, np.frombuffer(part.as_py(), "<u2"), 1)
        packed = np.packbits(n >= hits, bitorder="little").tobytes()
        return pa.table({"block": table.column("block")[:1].combine_chunks(), "bits": pa.array([packed], pa.binary())})

    counted = keys.mapInArrow(count, "block int, once binary, twice binary")
    merged = counted.groupBy("block").applyInArrow(merge, "block int, bits binary")
    out = bytearray(bits // 8)
    for r in merged.collect():  # bits / 8 bytes in all
        at = r["block"] * (BLOCK_BITS // 8)
        out[at : at + BLOCK_BITS // 8] = r["bits"]
    return bytes(out)


def _in_filter(spark, bits_set: bytes):
    """A function of (h1, h2) that is true where all cells are set. The filter's size is bounded."""
    shared = spark.sparkContext.broadcast(bits_set)

    @F.pandas_udf("boolean")
    def test(h1, h2):
        import pandas as pd

        table = np.frombuffer(shared.value, np.uint8)
        cells = _cells(h1.to_numpy(np.int64), h2.to_numpy(np.int64), 8 * len(table))
        return pd.Series(((table[cells >> 3] >> (cells & 7)) & 1).all(axis=0))

    return test("h1", "h2")


def mark_repeated(digests: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """digests (with digest, h1, h2) with `repeated`: false only for digests that occur once."""
    spark = digests.sparkSession
    rows = digests.count()
    slices = max(1, math.ceil(rows * BITS_PER_ROW / filter_bits))
    bits = _filter_bits(math.ceil(rows / slices), filter_bits)
    edges = [-(1 << 63) + (k * (1 << 64)) // slices for k in range(1, slices)]
    path = scratch_path(spark, "repeated")
    for low, high in zip([None, *edges], [*edges, None]):
        part = digests
        if low is not None:
            part = part.filter(F.col("h1") >= F.lit(low))
        if high is not None:
            part = part.filter(F.col("h1") < F.lit(high))
        twice = filter_of(part.select("h1", "h2"), bits, 2)
        part.withColumn("repeated", _in_filter(spark, twice)).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def exact_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_bits: int = FILTER_BITS
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    The smallest doc_id of equal texts stays (a null id only if there is no other). If rows repeat
    with that same id, one of them is kept. Null and empty texts are equal to each other. Other
    columns are ignored. What is shuffled is id and digest of possibly repeated rows.
    """
    rows = picked(docs, doc_id=doc_id, text=text).select("doc_id", digest().alias("digest"))
    hashed = materialize(rows.select("doc_id", "digest", *_hash_pair()).sortWithinPartitions("h1"), "digests")
    marked = mark_repeated(hashed, filter_bits)
    once = marked.filter(~F.col("repeated")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "digest",
    )
    pairs = marked.filter("repeated").groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    pairs = materialize(pairs, "digest-ids")
    # written, so that both sides of the join below are dealt out for it and a hot digest can be split
    groups = materialize(
        pairs.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")), "digest-groups"
    )
    again = (
        pairs.join(groups, "digest")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
        .select(
            "doc_id", "keep_id", "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "digest",
        )
    )
    return once.unionByName(again).withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


def deduplicate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_bits: int = FILTER_BITS
) -> DataFrame:
    """docs without the rows that exact_groups does not keep; all columns.

    Rows whose digest occurs once pass straight through. The others, told by a second filter over
    the repeated digests, are reduced to the first row of a digest within each task before they are
    shuffled, so neither a large group of copies nor their texts meet in one place. That filter has
    the same greatest size; beyond its room more rows take the second way, with the same result.
    """
    spark = docs.sparkSession
    h = [fresh(docs, n) for n in ("h1", "h2", "digest")]
    if h != ["h1", "h2", "digest"]:
        back = {f"c{k}": c for k, c in enumerate(docs.columns)}
        plain = docs.toDF(*back)
        named = {v: k for k, v in back.items()}
        return deduplicate(plain, named[doc_id], named[text], filter_bits).toDF(*docs.columns)
    rows = picked(docs, text=text).select(digest().alias("digest"))
    hashed = materialize(rows.select("digest", *_hash_pair()).sortWithinPartitions("h1"), "digests")
    repeated = mark_repeated(hashed, filter_bits).filter("repeated").select("digest", "h1", "h2").distinct()
    repeated = materialize(repeated, "repeated-digests")
    found = filter_of(repeated.select("h1", "h2"), _filter_bits(repeated.count(), filter_bits), 1)
    tested = docs.withColumn("digest", digest(text)).withColumns(
        {"h1": F.xxhash64("digest"), "h2": F.xxhash64("digest", F.lit(1))}
    )
    tested = tested.withColumn(fresh(docs, "again"), _in_filter(spark, found))
    again = tested.columns[-1]
    first = F.min_by(F.struct(*docs.columns), F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.col(text)))
    reduced = tested.filter(again).groupBy("digest").agg(first.alias("row")).select("row.*")
    return tested.filter(~F.col(again)).select(*docs.columns).unionByName(reduced)
