"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints within `distance` bits are found among distinct fingerprints only:

1. Bits are put into units of four so that correlated bits share a unit (measured over all
   fingerprints), and units into parts.
2. If part i may differ in t_i bits and the t_i + 1 add up to distance + 1, two fingerprints
   within the distance agree up to t_i bits in at least one part. Dynamic programming chooses
   the t_i (unequal, -1 leaves a part out) that make the fewest signatures and candidates; the
   candidates are estimated from the exact distribution of differences within each unit.
3. Each fingerprint sends a signature per part and, where t_i > 0, its neighbours. Equal
   signatures meet, and each pair that meets is verified on all 64 bits.

A bucket emits only links that join two of its local components, at most one fewer than it has
members, and never its pairs. A bucket above BUCKET_ROWS is cut into chunks, and pairs of
chunks are verified as buckets of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import field_type, fresh, longs, picked, strings
from cartlens.llm.components import components
from cartlens.session import materialize

SHINGLE_WORDS = 4
DISTANCE = 4
SEED = 42
BUCKET_ROWS = 50_000
SPAN_WORDS = 50_000
UNIT = 4
# a signature is written, shuffled and sorted; a candidate is one comparison in memory
SIGNATURE_COST = 50.0
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Majority of each bit of XXH64 over all word shingles, repeats included; 0 without words."""
    from xxhash import xxh64_intdigest

    rest, words, hashes = text.encode("utf-8", "surrogatepass").lower(), [], []
    counts, n = np.zeros(64, np.int64), 0
    while rest or words:
        more = rest.split(None, SPAN_WORDS)
        rest = more.pop() if len(more) > SPAN_WORDS else b""
        words += more
        if len(words) >= shingle:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = (ends - [len(w) + 1 for w in words]).tolist()
            stops = (ends[shingle - 1 :] - 1).tolist()
            hashes = [xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, stops)]
        elif words and not n and not rest:
            hashes = [xxh64_intdigest(b" ".join(words), seed)]
        if hashes:
            parts = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
            for k in range(8):
                counts[8 * k : 8 * k + 8] += np.bincount(parts[:, k], minlength=256) @ BYTE_BITS
            n += len(hashes)
            hashes = []
        if not rest:
            break
        words = words[-(shingle - 1) :] if shingle > 1 else []
    bits = (2 * counts > n).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in strings(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    kind = field_type(docs, doc_id)
    return picked(docs, doc_id=doc_id, text=text).mapInArrow(run, f"doc_id {kind}, fp bigint")


# ---- choice of parts and thresholds


def _bits_of(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_pairs(prints: DataFrame) -> np.ndarray:
    """64 x 64 counts of bits that are set together, over all fingerprints. One row for each pair
    of bits and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64))
        for batch in batches:
            bits = _bits_of(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float64)
            total += bits.T @ bits
        pair = np.arange(4096, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pair), longs(total.ravel())], ["pair", "n"])

    rows = prints.select("fp").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(4096)
    for r in rows:
        out[r["pair"]] = r["n"]
    return out.reshape(64, 64)


def correlated_order(pairs: np.ndarray, n: int) -> list[int]:
    """Bits in an order in which each unit of UNIT neighbours holds correlated bits."""
    mean = np.diag(pairs) / max(n, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    close = np.abs((pairs / max(n, 1) - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(close, -1)
    left, order = set(range(64)), []
    while left:
        rows = sorted(left)
        inside = close[np.ix_(rows, rows)]
        unit = [rows[int(np.argmax(inside.max(axis=1)))]]
        left.discard(unit[0])
        while left and len(unit) < UNIT:
            best = max(sorted(left), key=lambda b: close[b, unit].sum())
            unit.append(best)
            left.discard(best)
        order += unit
    return order


def unit_counts(prints: DataFrame, order: list[int]) -> np.ndarray:
    """How often each unit has each of its values, over all fingerprints."""
    units, size = 64 // UNIT, 1 << UNIT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(units * size, np.int64)
        for batch in batches:
            bits = _bits_of(batch.column(0).to_numpy(zero_copy_only=False))[:, order].reshape(-1, units, UNIT)
            values = bits @ (1 << np.arange(UNIT)) + size * np.arange(units)
            total += np.bincount(values.ravel(), minlength=units * size)
        cells = np.arange(units * size, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total)], ["cell", "n"])

    rows = prints.select("fp").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(units * size)
    for r in rows:
        out[r["cell"]] = r["n"]
    return out.reshape(units, size)


def difference_shares(counts: np.ndarray) -> np.ndarray:
    """Per unit, the share of all pairs that differ in 0, 1, .. UNIT bits."""
    size = counts.shape[1]
    distance = np.bitwise_count(np.arange(size)[:, None] ^ np.arange(size)[None, :])
    shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    out = np.zeros((len(counts), UNIT + 1))
    for u, p in enumerate(shares):
        np.add.at(out[u], distance, np.outer(p, p))
    return out


def signatures_of(t: int, width: int) -> int:
    """Signatures one fingerprint sends for a part: all values within ceil(t / 2) bits."""
    reach = (t + 1) // 2
    return 0 if t < 0 else sum(len(list(combinations(range(width), k))) for k in range(reach + 1))


def choose_parts(counts: np.ndarray, n: int, distance: int) -> list[tuple[list[int], int]]:
    """The cheapest parts: (units, t) for each part that is used.

    For every number of parts the t are found by dynamic programming over parts and over how much
    of distance + 1 is spent.
    """
    units = len(counts)
    shares = difference_shares(counts)
    best: tuple[float, list] = (np.inf, [])
    for m in range(1, distance + 2):
        bounds = [round(k * units / m) for k in range(m + 1)]
        parts = [list(range(a, b)) for a, b in zip(bounds, bounds[1:])]
        table: dict[int, tuple[float, list]] = {0: (0.0, [])}
        for part in parts:
            spread = np.ones(1)
            for u in part:
                spread = np.convolve(spread, shares[u])
            step: dict[int, tuple[float, list]] = {}
            for spent, (cost, chosen) in table.items():
                for t in range(-1, distance - spent + 1):
                    near = spread[: t + 1].sum() if t >= 0 else 0.0
                    now = cost + SIGNATURE_COST * n * signatures_of(t, UNIT * len(part)) + n * n / 2 * near
                    if spent + t + 1 not in step or now < step[spent + t + 1][0]:
                        step[spent + t + 1] = (now, [*chosen, t])
            table = step
        cost, chosen = table[distance + 1]
        if cost < best[0]:
            best = (cost, [(p, t) for p, t in zip(parts, chosen) if t >= 0])
    return best[1]


# ---- signatures, buckets and links


def _masks(bits: list[int], reach: int) -> list[tuple[int, int]]:
    """(bits flipped, how many) for all values of a part within `reach`."""
    return [(sum(1 << b for b in c), k) for k in range(reach + 1) for c in combinations(bits, k)]


def signatures(prints: DataFrame, order: list[int], parts: list[tuple[list[int], int]]) -> DataFrame:
    """part, value, fp, away (bits between the value and the fingerprint's own)."""
    plan = []
    for number, (units, t) in enumerate(parts):
        bits = [order[UNIT * u + k] for u in units for k in range(UNIT)]
        flips = _masks(bits, (t + 1) // 2)
        whole = sum(1 << b for b in bits)
        plan.append((number, whole, np.array([f for f, _ in flips], np.uint64), np.array([k for _, k in flips], np.int8)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for number, whole, flips, away in plan:
                step = max(1, 200_000 // len(flips))
                for at in range(0, len(fps), step):
                    some = fps[at : at + step]
                    values = ((some & np.uint64(whole))[:, None] ^ flips[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(values), number, np.int8)),
                            pa.array(values.view(np.int64)),
                            pa.array(np.repeat(some, len(flips)).view(np.int64)),
                            pa.array(np.tile(away, len(some))),
                        ],
                        ["part", "value", "fp", "away"],
                    )

    return prints.select("fp").mapInArrow(run, "part tinyint, value bigint, fp bigint, away tinyint")


def _forest(start: np.ndarray, fps: np.ndarray, away: np.ndarray, side: np.ndarray, limits: np.ndarray, distance: int):
    """Links that join local components of buckets. Rows are sorted by bucket; start is each row's
    bucket number, side the chunk (0, 1) or 2 if the whole bucket is here, limits t per row."""
    root = np.arange(len(fps))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    links = []
    left = np.arange(len(fps) - 1)
    lag = 1
    while len(left):
        left = left[left + lag < len(fps)]
        left = left[start[left] == start[left + lag]]
        a, b = left, left + lag
        far, near = np.maximum(away[a], away[b]), np.minimum(away[a], away[b])
        meet = (far <= (limits[a] + 1) // 2) & (near <= limits[a] // 2)
        meet &= (side[a] == 2) | (side[a] != side[b])
        meet &= (fps[a] != fps[b]) & (np.bitwise_count(fps[a] ^ fps[b]) <= distance)
        meet &= root[a] != root[b]
        for x, y in zip(a[meet].tolist(), b[meet].tolist()):
            rx, ry = find(x), find(y)
            if rx != ry:
                root[max(rx, ry)] = min(rx, ry)
                links.append((x, y))
        if meet.any():
            flat = root[root]
            while (flat != root).any():
                root[:] = flat
                flat = root[root]
        lag += 1
    return links


def _verify(rows: DataFrame, keys: list[str], limits: list[int], distance: int, most: int | None) -> DataFrame:
    """u, v for verified links; rows of buckets above `most` come out as they are with their chunk.

    rows must hold keys, part, value, fp, away, side. A bucket is one value of all keys.
    """
    schema = "u bigint, v bigint, part tinyint, value bigint, fp bigint, away tinyint, chunk int"
    per_part = np.array(limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(held: pa.Table) -> pa.RecordBatch:
            col = {n: held.column(n).to_numpy() for n in dict.fromkeys([*keys, "part", "fp", "away", "side"])}
            new = np.zeros(held.num_rows, bool)
            for k in keys:
                new[1:] |= col[k][1:] != col[k][:-1]
            fps = col["fp"].astype(np.int64).view(np.uint64)
            found = _forest(np.cumsum(new), fps, col["away"], col["side"], per_part[col["part"]], distance)
            pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
            u, v = (pa.array(fps[pairs[:, k]].view(np.int64)) for k in (0, 1))
            rest = [pa.nulls(len(pairs), t) for t in (pa.int8(), pa.int64(), pa.int64(), pa.int8(), pa.int32())]
            return pa.RecordBatch.from_arrays([u, v, *rest], ["u", "v", "part", "value", "fp", "away", "chunk"])

        def passed(rows: pa.Table, first: int) -> Iterator[pa.RecordBatch]:
            chunk = ((first + np.arange(rows.num_rows)) // most).astype(np.int32)
            out = pa.table(
                {
                    "u": pa.nulls(rows.num_rows, pa.int64()), "v": pa.nulls(rows.num_rows, pa.int64()),
                    **{n: rows.column(n) for n in ("part", "value", "fp", "away")}, "chunk": pa.array(chunk),
                }
            )
            yield from out.combine_chunks().to_batches()

        held: pa.Table | None = None
        large = 0  # rows of the open bucket that were passed on already
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < 20_000:
                continue
            held = held.combine_chunks()
            changes = np.zeros(held.num_rows, bool)
            for k in keys:
                c = held.column(k).to_numpy()
                changes[1:] |= c[1:] != c[:-1]
            at = np.flatnonzero(changes)
            if large:
                end = int(at[0]) if len(at) else held.num_rows
                yield from passed(held.slice(0, end), large)
                large = 0 if len(at) else large + end
                held, at = held.slice(end), at[1:] - end
            last = int(at[-1]) if len(at) else 0
            if last:
                yield linked(held.slice(0, last))
                held = held.slice(last)
            if most and held.num_rows > most and not large:
                yield from passed(held, 0)
                large, held = held.num_rows, held.slice(0, 0)
        if held is not None and held.num_rows:
            if large:
                changes = np.zeros(held.num_rows, bool)
                for k in keys:
                    c = held.column(k).to_numpy()
                    changes[1:] |= c[1:] != c[:-1]
                at = np.flatnonzero(changes)
                end = int(at[0]) if len(at) else held.num_rows
                yield from passed(held.slice(0, end), large)
                held = held.slice(end)
            if held.num_rows:
                yield linked(held)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def links(prints: DataFrame, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """u, v: links between distinct fingerprints (column fp) within `distance` bits. Every
    pair within the distance is connected through links, directly or by others of its buckets."""
    n = prints.count()
    order = correlated_order(bit_pairs(prints), n)
    parts = choose_parts(unit_counts(prints, order), n, distance)
    limits = [t for _, t in parts]
    rows = signatures(prints, order, parts).withColumn("side", F.lit(2).cast("tinyint"))
    first = materialize(_verify(rows, ["part", "value"], limits, distance, bucket_rows), "links")
    found = first.filter(F.col("u").isNotNull()).select("u", "v")
    large = first.filter(F.col("u").isNull()).select("part", "value", "fp", "away", "chunk")
    chunks = large.groupBy("part", "value").agg((F.max("chunk") + 1).alias("chunks"))
    spread = (
        large.join(chunks, ["part", "value"])
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "part", "value", "fp", "away",
            F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
            F.when(F.col("chunk") == F.col("other"), 2).when(F.col("chunk") < F.col("other"), 0).otherwise(1)
            .cast("tinyint").alias("side"),
        )
    )
    second = _verify(spread, ["part", "value", "low", "high"], limits, distance, None)
    return found.unionByName(second.select("u", "v"))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE_WORDS,
    distance: int = DISTANCE,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that can be reached over fingerprints within the distance,
    the row's own included. A null or wordless text has fingerprint zero and is linked like any
    other; a null doc_id counts only where a component has no other. Repeated rows share their
    fingerprint; other columns are ignored; an empty table gives an empty result.
    """
    return _grouped(docs, doc_id, text, shingle, distance, bucket_rows).drop("root")


def _grouped(docs: DataFrame, doc_id: str, text: str, shingle: int, distance: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """near_duplicates with root, a fingerprint that stands for the component: if ids repeat, two components
    can have the same smallest id."""
    prints = materialize(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    nodes = materialize(components(links(classes, distance, bucket_rows)), "components")
    roots = nodes.join(classes, nodes["node"] == classes["fp"]).groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = nodes.join(roots, "root").select(F.col("node").alias("fp"), "root", F.col("component_id").alias("linked_id"))
    ids = classes.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("linked_id", "first_id").alias("component_id")
    )
    return prints.join(materialize(ids, "component-ids"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root"
    )


def deduplicate(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE_WORDS,
    distance: int = DISTANCE,
) -> DataFrame:
    """docs with one document of each group, the one with the smallest doc_id; all columns.

    If several rows have that id, the one with the smallest fingerprint and then text stays. The
    rows to leave out are a narrow list of ids; texts are moved once, for the join with it. Ids
    that stand on several rows are rare; their rows are taken apart by fingerprint.
    """
    groups = materialize(_grouped(docs, doc_id, text, shingle, distance), "near-groups")
    several = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    several = materialize(several, "several-ids")
    lost = groups.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id")
    lost = materialize(lost.unionByName(several).distinct(), "near-lost")
    name = fresh(docs, "found_id")
    match = docs[doc_id].eqNullSafe(F.col(name))
    single = docs.join(lost.withColumnRenamed("doc_id", name), match, "left_anti")
    if not several.take(1):
        return single

    @F.pandas_udf("bigint")
    def printed(texts):
        import pandas as pd

        prints = np.array([fingerprint(t or "", shingle) for t in texts], dtype=np.uint64)
        return pd.Series(prints.view(np.int64))

    column = fresh(docs, "print")
    rows = docs.join(several.withColumnRenamed("doc_id", name), match, "left_semi")
    rows = rows.withColumn(column, F.lower(F.lpad(F.hex(printed(docs[text])), 16, "0")))
    kept = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).distinct().withColumnRenamed("doc_id", name)
    rows = rows.join(kept, rows[doc_id].eqNullSafe(kept[name]) & (rows[column] == kept["fingerprint"]))
    order = F.struct(kept["fingerprint"], rows[text].isNull(), rows[text])
    first = F.min_by(F.struct(*[rows[c] for c in docs.columns]), order).alias("row")
    return single.unionByName(rows.groupBy(kept["root"]).agg(first).select("row.*"))
