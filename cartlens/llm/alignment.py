"""Alignment of two tokenizers over the same bytes.

Both encode the space and the text. The ends of their tokens, counted in bytes, are put in one
dictionary from end to index for each side; the sorted keys that both have cut the two id lists
into groups, and inside a group every pair of tokens whose byte ranges overlap is a link.

Texts are cut into parts at single spaces, and parts into units before closing punctuation and line
ends, where neither tokenizer joins bytes (its vocabulary is searched and this is probed; otherwise texts
are aligned whole). Parts and units are cached with their groups and links.

For figures that need the whole corpus, each document's distinct links are written once. Their
corpus-wide counts are summed by id pair. Pairs with at least total / FREQUENT_PAIRS links, which are at
most FREQUENT_PAIRS, go to every task as a sorted array; links of rarer pairs, none of which is hot,
are joined. Both ways are taken at every size.
"""

from __future__ import annotations

import array
import hashlib
import os
import re
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import field_type, longs, no_cycle_search, picked, strings
from cartlens.session import materialize

FREQUENT_PAIRS = 1 << 20
FLUSH_LINKS = 1 << 21
CACHE_PARTS = 400_000
CACHED_CHARS = 64
CUT = re.compile(r"(?<=\S) (?=\S)")
# Inside a part: between a Latin letter and closing punctuation, and before a line's end.
LETTER, CLOSING = "A-Za-zÀ-ÖØ-öø-ɏ", ".,;:!?)"
INNER_CUT = re.compile(rf"(?<=[{LETTER}])(?=[{CLOSING}])|(?<=\S)(?=\n)")
JOINED = re.compile(rf"[{LETTER}][{CLOSING}]|\n|[^▁]▁")
PROBES = ("one two  three", "end. Next, (so) he said: yes!\nLine.\n\nNew", "x.y,z)", "été.\nÉt", "it's a 12 kg, (odd) -- thing.", "x \n y\n\n z \t", "é ß 漢 字 😀 a", "  lead and trail  ", "a ' b's ...")


# ------------------------------------------------------------------- one text


def split_groups(a_sizes: Sequence[int], b_sizes: Sequence[int]) -> list[tuple[int, int, int, int]]:
    """Index ranges (first a, last a, first b, last b), ends excluded, between the byte offsets where both end."""
    a_ends = {end: k for k, end in enumerate(accumulate(a_sizes), 1)}
    b_ends = {end: k for k, end in enumerate(accumulate(b_sizes), 1)}
    groups, a, b = [], 0, 0
    for end in sorted(a_ends.keys() & b_ends.keys()):
        groups.append((a, a_ends[end], b, b_ends[end]))
        a, b = a_ends[end], b_ends[end]
    return groups


def expand_links(a_sizes: Sequence[int], b_sizes: Sequence[int], group: tuple[int, int, int, int]) -> list[tuple[int, int]]:
    """Index pairs of a group's tokens whose byte ranges overlap, in order."""
    a, a_last, b, b_last = group
    if a_last - a == 1:
        return [(a, k) for k in range(b, b_last)]
    if b_last - b == 1:
        return [(k, b) for k in range(a, a_last)]
    links, a_end, b_end = [], a_sizes[a], b_sizes[b]
    while True:
        links.append((a, b))
        if a + 1 == a_last and b + 1 == b_last:
            return links
        # inside a group the two never end together before its last tokens
        if a_end < b_end:
            a += 1
            a_end += a_sizes[a]
        else:
            b += 1
            b_end += b_sizes[b]


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: visible ones stand for themselves,
    the others are counted on from 256."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level tokenizer file; encode gives the ids of a space and the text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        letters = byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = {k: bytes(letters[c] for c in token) for token, k in vocabulary.items() if letters.keys() >= set(token)}
        self.size = 1 + max(self.tokenizer.get_vocab().values())
        self.space = next(letter for letter, byte in letters.items() if byte == 0x20)
        words = ["word", "Xyzzyqueousness"]
        self.splits_words = False
        self.splits_words = self.encode(words) == [[t.id for t in self.tokenizer.model.tokenize(self.space + w)] for w in words]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of a space and each text. A plain word is one piece for the merges, which can be asked at once."""
        merges, space = self.tokenizer.model.tokenize, self.space
        others = [k for k, t in enumerate(texts) if not (self.splits_words and t.isalpha() and t.isascii())]
        if len(others) == len(texts):
            return self.encode_exactly([" " + t for t in texts])
        rest = dict(zip(others, self.encode_exactly([" " + texts[k] for k in others])))
        return [rest[k] if k in rest else [t.id for t in merges(space + text)] for k, text in enumerate(texts)]

    def encode_exactly(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """A sentence-piece model, which puts the space before the text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        names = [model.id_to_piece(k) for k in range(self.size)]
        self.bytes_of = {
            k: bytes([int(name[3:5], 16)]) if model.is_byte(k) else name.replace("▁", " ").encode() for k, name in enumerate(names)
        }
        self.joins_at_cuts = any(JOINED.search(name) for name in names)
        self.encode = lambda texts: model.encode(texts, num_threads=1)
        self.line_start = self.encode(["\n"])[0]

    def encode_exactly(self, texts: list[str]) -> list[list[int]]:
        """Ids without the space that the model puts first: a line's end takes its place and is left out."""
        skip = len(self.line_start)
        return [ids[skip:] for ids in self.encode(["\n" + t for t in texts])]


# What one part adds: n_a, n_b, n_groups, n_links, groups as text, links as packed pairs.
Part = tuple[int, int, int, int, str, bytes]


class Aligner:
    """Aligns texts, part by part where that is the same as whole. Parts and units that were met are kept; one
    whose tokens do not spell its bytes is kept as None.

    Every pair of ids is numbered a * (ids of B) + b.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.kind = pair_type(self.a.size, self.b.size)
        self.code = "I" if self.kind == "<u4" else "q"
        self.a_bytes, self.b_bytes = ([side.bytes_of.get(k, b"") for k in range(side.size)].__getitem__ for side in (self.a, self.b))
        self.met: dict[str, Part | None] = {}
        self.heads: dict[str, Part | None] = {}
        self.tails: dict[str, Part | None] = {}
        self.long: list[tuple[dict, str]] = []
        self.by_part = not self.b.joins_at_cuts and all(
            side.encode([p])[0] == [k for part in CUT.split(p) for k in self._by_unit(side, part)] for side in (self.a, self.b) for p in PROBES
        )

    @staticmethod
    def _by_unit(side: ByteLevel | Pieces, part: str) -> list[int]:
        head, *tails = INNER_CUT.split(part)
        return [k for ids in (*side.encode([head]), *side.encode_exactly(tails)) for k in ids]

    def tokens(self, text: str) -> tuple[list[int], list[int], list[int], list[int]] | None:
        """Ids and sizes of both sides, or None if either does not spell a space and the text."""
        a, b = self.a.encode([text])[0], self.b.encode([text])[0]
        a_bytes, b_bytes = [self.a.bytes_of.get(k, b"") for k in a], [self.b.bytes_of[k] for k in b]
        whole = (" " + text).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return None
        return a, b, list(map(len, a_bytes)), list(map(len, b_bytes))

    def _aligned(self, whole: str, a: list[int], b: list[int]) -> Part | None:
        a_bytes, b_bytes = list(map(self.a_bytes, a)), list(map(self.b_bytes, b))
        data = whole.encode()
        if b"".join(a_bytes) != data or b"".join(b_bytes) != data:
            return None
        size = self.b.size
        if len(a) == 1 or len(b) == 1:
            pairs = [i * size + j for i in a for j in b]
            n, digest = 1, f"{','.join(map(str, a))}|{','.join(map(str, b))}"
        else:
            a_sizes, b_sizes = list(map(len, a_bytes)), list(map(len, b_bytes))
            groups, pairs, texts = split_groups(a_sizes, b_sizes), [], []
            for g in groups:
                i, j, k, m = g
                if j - i == m - k == 1:
                    pairs.append(a[i] * size + b[k])
                    texts.append(f"{a[i]}|{b[k]}")
                else:
                    pairs += [a[x] * size + b[y] for x, y in expand_links(a_sizes, b_sizes, g)]
                    texts.append(f"{','.join(map(str, a[i:j]))}|{','.join(map(str, b[k:m]))}")
            n, digest = len(groups), ";".join(texts)
        packed = array.array(self.code, pairs)
        if sys.byteorder == "big":
            packed.byteswap()
        return len(a), len(b), n, len(pairs), digest, packed.tobytes()

    def parts(self, text: str) -> list[str]:
        return (CUT.split(text) if self.by_part else [text]) if text else []

    def _meet_units(self, kept: dict[str, Part | None], units: set[str], before: str) -> None:
        """Align the units that are not kept, in one call of each tokenizer."""
        new = [u for u in units if u not in kept]
        self.long += [(kept, u) for u in new if len(u) > CACHED_CHARS]
        sides = (self.a.encode(new), self.b.encode(new)) if before else (self.a.encode_exactly(new), self.b.encode_exactly(new))
        for u, a, b in zip(new, *sides):
            kept[u] = self._aligned(before + u, a, b)

    def meet(self, parts: Iterable[str]) -> None:
        """Align the parts that are not kept."""
        for kept, p in self.long:
            kept.pop(p, None)
        wanted = set(parts)
        new = [p for p in wanted if p not in self.met]
        if len(self.met) + len(new) > CACHE_PARTS:
            self.met.clear()
            new = list(wanted)
        for kept in (self.heads, self.tails):
            if len(kept) + len(new) > CACHE_PARTS:
                kept.clear()
        self.long = [(self.met, p) for p in new if len(p) > CACHED_CHARS]
        units = [[p] if p.isalpha() or not self.by_part else INNER_CUT.split(p) for p in new]
        self._meet_units(self.heads, {u[0] for u in units}, " ")
        self._meet_units(self.tails, {t for u in units for t in u[1:]}, "")
        heads, tails = self.heads, self.tails
        for p, cut in zip(new, units):
            if len(cut) == 1:
                self.met[p] = heads[p]
                continue
            found = [heads[cut[0]], *map(tails.__getitem__, cut[1:])]
            if None in found:
                self.met[p] = None
                continue
            n_a, n_b, groups, links, texts, pairs = zip(*found)
            self.met[p] = (sum(n_a), sum(n_b), sum(groups), sum(links), ";".join(texts), b"".join(pairs))

    def align(self, text: str) -> tuple[int, int, int, int, str, np.ndarray]:
        return next(self.align_all([text]))

    def align_all(self, texts: Iterable[str]) -> Iterator[tuple[int, int, int, int, str, np.ndarray]]:
        """For each text the counts, the digest of its groups, and the sorted pairs of its links; zeros without tokens."""
        cut = list(map(self.parts, texts))
        self.meet(p for parts in cut for p in parts)
        return map(self._sums, cut)

    def _sums(self, parts: list[str]) -> tuple[int, int, int, int, str, np.ndarray]:
        found = list(map(self.met.__getitem__, parts))
        if not found or None in found:
            return 0, 0, 0, 0, "", np.zeros(0, self.kind)
        n_a, n_b, groups, links, texts, pairs = zip(*found)
        digest = hashlib.sha256(";".join(texts).encode()).hexdigest()
        return sum(n_a), sum(n_b), sum(groups), sum(links), digest, np.sort(np.frombuffer(b"".join(pairs), self.kind))


def pair_type(a_size: int, b_size: int) -> str:
    return "<u4" if a_size * b_size <= 1 << 32 else "<i8"


# ------------------------------------------------------------------- operators


def groups(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per group: doc_id, place (from 0), start, stop (bytes of the space and the text), a_ids, b_ids.

    Texts that are null or empty, or that either tokenizer does not spell byte by byte, have no groups.
    Repeated rows are aligned each for itself; other columns are left out.
    """
    schema = f"doc_id {field_type(docs, doc_id)}, place bigint, start bigint, stop bigint, a_ids array<int>, b_ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for batch in batches:
            for row, t in enumerate(strings(batch.column(1))):
                got = aligner.tokens(t)
                if not got:
                    continue
                a, b, a_sizes, b_sizes = got
                cut = split_groups(a_sizes, b_sizes)
                stops = np.cumsum([sum(b_sizes[k:m]) for _, _, k, m in cut])
                ids = [pa.array([x[i:j] for x, i, j in picks], pa.list_(pa.int32())) for picks in (
                    [(a, i, j) for i, j, _, _ in cut], [(b, k, m) for _, _, k, m in cut])]
                names = batch.column(0).take(pa.array(np.full(len(cut), row)))
                yield pa.RecordBatch.from_arrays(
                    [names, longs(np.arange(len(cut))), longs(np.r_[0, stops[:-1]]), longs(stops), *ids],
                    ["doc_id", "place", "start", "stop", "a_ids", "b_ids"],
                )

    return picked(docs, doc_id=doc_id, text=text).mapInArrow(run, schema)


def _linked(docs: DataFrame, a_path: str, b_path: str, doc_id: str, text: str) -> DataFrame:
    """Per document its figures, and its distinct pairs with their numbers of links, packed."""
    schema = (
        f"doc_row bigint, doc_id {field_type(docs, doc_id)}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups_sha256 string, pairs binary, times binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner(a_path, b_path), TaskContext.get().partitionId() << 33
        with no_cycle_search():
            for batch in batches:
                rows, packed, times = [], [], []
                for *figures, links in aligner.align_all(strings(batch.column(1))):
                    pairs, n = np.unique(links, return_counts=True)
                    rows.append(figures)
                    packed.append(pairs.tobytes())
                    times.append(n.astype("<u4").tobytes())
                *counts, digests = zip(*rows) if rows else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        longs(np.arange(number, number + len(rows))), batch.column(0), *map(longs, counts),
                        pa.array(digests, pa.string()), pa.array(packed, pa.binary()), pa.array(times, pa.binary()),
                    ],
                    [f.split()[0] for f in schema.split(", ")],
                )
                number += len(rows)

    return picked(docs, doc_id=doc_id, text=text).mapInArrow(run, schema)


def _unpacked(batch: pa.RecordBatch, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and times of all rows of a batch in one array each, and where each row's end."""
    packed = batch.column("pairs").to_pylist()
    pairs = np.frombuffer(b"".join(packed), kind).astype(np.int64)
    times = np.frombuffer(b"".join(batch.column("times").to_pylist()), "<u4").astype(np.int64)
    return pairs, times, np.cumsum([len(x) // np.dtype(kind).itemsize for x in packed], dtype=np.int64)


def _pair_counts(linked: DataFrame, kind: str) -> DataFrame:
    """pair, n: links that hold the pair, over all documents. Tasks add up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            pairs, place = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            n = np.zeros(len(pairs), np.int64)
            np.add.at(n, place, np.concatenate([t for _, t in held]))
            return pairs, n

        def rows(sums: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([longs(sums[0]), longs(sums[1])], ["pair", "n"])

        for batch in batches:
            pairs, times, _ = _unpacked(batch, kind)
            held.append((pairs, times))
            size += len(pairs)
            if size >= FLUSH_LINKS:
                sums = added()
                if len(sums[0]) > FLUSH_LINKS // 2:
                    yield rows(sums)
                    held, size = [], 0
                else:
                    held, size = [sums], len(sums[0])
        if size:
            yield rows(added())

    summed = linked.select("pairs", "times").mapInArrow(run, "pair bigint, n bigint")
    return summed.groupBy("pair").agg(F.sum("n").alias("n"))


def _with_best(pairs: DataFrame, b_size: int) -> DataFrame:
    """Each pair with its ids and best: whether no pair of the same B id has more links."""
    named = pairs.withColumn("b", F.col("pair") % b_size).withColumn("a", F.floor(F.col("pair") / F.lit(b_size)))
    # one row for each id of vocabulary B
    highest = named.groupBy("b").agg(F.max("n").alias("highest"))
    return named.join(F.broadcast(highest), "b").select("pair", "a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))


def _sizes(a_path: str, b_path: str) -> tuple[int, int]:
    return ByteLevel(a_path).size, Pieces(b_path).size


def link_counts(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """a, b, n, best: how many links of the corpus hold the two ids, and whether that is the most for the B id."""
    a_size, b_size = _sizes(a_path, b_path)
    counts = _pair_counts(_linked(docs, a_path, b_path, doc_id, text), pair_type(a_size, b_size))
    return _with_best(materialize(counts, "pair-counts"), b_size).drop("pair")


def align_documents(
    docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", frequent_pairs: int = FREQUENT_PAIRS
) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is the most frequent of
    its B id in the corpus, ties included), count_sum (corpus-wide counts summed over its links), groups_sha256.

    A text that is null or empty, or that either tokenizer does not spell byte by byte, has zeros and an
    empty digest. Repeated rows count each for itself, null ids are kept, an empty table gives no rows, other
    columns are left out. frequent_pairs bounds what every task holds: so many pairs of 17 bytes.
    """
    a_size, b_size = _sizes(a_path, b_path)
    kind = pair_type(a_size, b_size)
    linked = materialize(_linked(docs, a_path, b_path, doc_id, text), "links")
    counts = materialize(_pair_counts(linked, kind), "pair-counts")
    pairs = _with_best(counts, b_size)
    total = counts.agg(F.sum("n")).first()[0] or 0
    # no more than total / least pairs can have that many links
    least = max(1, -(-total // frequent_pairs))
    table = pairs.filter(F.col("n") >= least).select("pair", "n", "best").toArrow().sort_by("pair")
    known = linked.sparkSession.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("pair", "n", "best")))
    figures = [c for c in linked.columns if c not in ("pairs", "times")]
    scored = linked.mapInArrow(_scorer(known, kind, figures), _scored_schema(linked, figures))
    rare = scored.select("doc_row", F.inline("rare"))
    rare_sums = rare.join(pairs.filter(F.col("n") < least).select("pair", "n", "best"), "pair").groupBy("doc_row").agg(
        F.sum(F.when(F.col("best"), F.col("times"))).alias("rare_best"), F.sum(F.col("times") * F.col("n")).alias("rare_sum")
    )
    joined = scored.drop("rare").join(rare_sums, "doc_row", "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("rare_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", zero)).alias("count_sum"),
        "groups_sha256",
    )


def _scored_schema(linked: DataFrame, figures: list[str]) -> str:
    columns = ", ".join(f"{c} {field_type(linked, c)}" for c in figures)
    return f"{columns}, n_best bigint, count_sum bigint, rare array<struct<pair: bigint, times: bigint>>"


def _scorer(known, kind: str, figures: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums over the links of frequent pairs, and the links that are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = known.value
        for batch in batches:
            pairs, times, ends = _unpacked(batch, kind)
            place = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            hit = keys[place] == pairs if len(keys) else np.zeros(len(pairs), bool)
            counts, bests = (np.where(hit, x[place], 0) if len(keys) else np.zeros(len(pairs), np.int64) for x in (n, best))

            def per_row(values: np.ndarray) -> np.ndarray:
                return np.diff(np.r_[0, np.r_[0, np.cumsum(values)][ends]])

            left = ~hit
            offsets = np.r_[0, np.cumsum(per_row(left))].astype(np.int32)
            links = pa.StructArray.from_arrays([longs(pairs[left]), longs(times[left])], ["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in figures), longs(per_row(times * bests)), longs(per_row(times * counts)),
                    pa.ListArray.from_arrays(pa.array(offsets), links),
                ],
                [*figures, "n_best", "count_sum", "rare"],
            )

    return run
