"""Byte-level BPE by prefix dynamic programming: encoding, decoding, appends and edits.

Where every token's parts have lower ranks than the token, merging goes up the ranks, and a sequence
of tokens is the BPE encoding of its bytes exactly if every two neighbours are the encoding of their
own bytes. (Vocabularies whose ranks are no such order are refused.) So each prefix of a piece has one valid last token: the one token
that ends there, fits behind the last token of the prefix before it, and goes on. `Prefixes`
stores it for every prefix. Appending only adds entries, and after an edit the entries are the
old ones again as soon as they agree over the longest token's length.

Texts are first split by the tokenizer's pattern, and pieces are encoded each for itself. The
library behind the rank files has its own Unicode tables; characters on which the two differ are
found by asking it, and texts that hold one are split with its classes.

Map-only: tasks encode and decode their own rows, nothing is shuffled.
"""

from __future__ import annotations

import array
import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, DataType, LongType, StructField, StructType

from cartlens.llm.common import field_type, fresh, longs, no_cycle_search, picked, strings
from cartlens.llm.tokens import pack_ids

CACHE_PIECES = 600_000
CACHED_CHARS = 64
PAIRS = 1 << 18
NEVER = 1 << 62
# The last characters a match of the pattern can depend on beyond its own end.
LOOKAHEAD = 2


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Vocabulary:
    """Tokens by id, all matches of tokens in a piece, and which tokens may follow each other."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has every single byte")
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.length_of = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        # the two tokens whose merge makes a token; one that merging never makes is only used for a piece that is just it
        self.halves: dict[int, list[int]] = {}
        self.whole_only: dict[bytes, int] = {}
        for token, rank in ranks.items():
            parts = self.merge(token, stop=2)
            if len(parts) == 2:
                self.halves[rank] = parts
                if any(p >= rank and len(self.bytes_of[p]) > 1 for p in parts):
                    raise ValueError("a token has a part of higher rank: the ranks are not an order of merges")
            elif len(parts) > 2:
                self.whole_only[token] = rank
        self.matches = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if token not in self.whole_only:
                self.matches.add_word(token.decode("latin-1"), (len(token), rank))
        self.matches.make_automaton()
        self.fits = lru_cache(PAIRS)(self._fits)
        self.edge = lru_cache(None)(self._edge)

    def merge(self, data: bytes, stop: int = 1) -> list[int]:
        """Encoding by its definition: merge the pair of lowest rank, the leftmost first, until `stop` parts are
        left. For short inputs."""
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > stop:
            found = [(r, k) for k in range(len(parts) - 1) if (r := self.ranks.get(parts[k] + parts[k + 1])) is not None]
            if not found:
                break
            _, k = min(found)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.ranks[p] for p in parts]

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at one edge of a token while it is merged, from the byte on, each with the rank of the
        merge that ends it."""
        out, end = [], NEVER
        while True:
            out.append((token, end))
            if token not in self.halves:
                return out[::-1]
            token, end = self.halves[token][side], token

    def _fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives the two back: no merge across the border may come before
        the merges that take its two parts away, where of equal ranks the one further left comes first."""
        a, b = self.edge(left, 1), self.edge(right, 0)
        i = j = 0
        while True:
            (u, u_end), (v, v_end) = a[i], b[j]
            across = self.ranks.get(self.bytes_of[u] + self.bytes_of[v])
            if across is not None and across < u_end and across <= v_end:
                return False
            if u_end <= v_end:
                if u_end == NEVER:
                    return True
                i += 1
            else:
                j += 1


    def encode(self, data: bytes) -> list[int]:
        """The tokens of a whole piece, from the last token of each of its prefixes (see Prefixes)."""
        last, fits, known, n = [-1], self.fits, 0, len(data)
        for end, (size, token) in self.matches.iter(data.decode("latin-1")):
            if end >= known and (end + 1 == size or fits(last[end + 1 - size], token)):
                last.append(token)
                known = end + 1
        out = []
        while n:
            token = last[n]
            out.append(token)
            n -= self.length_of[token]
        out.reverse()
        return out


class Prefixes:
    """The unique valid last token of every prefix of a growing, editable piece of bytes.

    last[i] belongs to the first i bytes. computed counts the entries worked out so far.
    """

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last = array.array("q", [-1])
        self.computed = 0
        self.append(data)

    def _fill(self, start: int, settled: Callable[[int], bool] | None = None) -> None:
        """Add the entries after the first `start` bytes, until all are there or settled(entry's place)."""
        last, fits, known = self.last, self.vocabulary.fits, start
        before = max(0, start - self.vocabulary.longest + 1)
        for end, (size, token) in self.vocabulary.matches.iter(self.data[before:].decode("latin-1")):
            at = before + end + 1
            # a match for a prefix that has its token already; or one that starts left of the data looked at
            if at <= known or at - size < before:
                continue
            if at == size or fits(last[at - size], token):
                last.append(token)
                known = at
                if settled is not None and settled(at):
                    break
        self.computed += known - start

    def append(self, more: bytes) -> None:
        start, self.data = len(self.data), self.data + more
        self._fill(start)

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Put new in place of bytes [start, stop); entries before start stay, later ones are reused
        once they agree with the old ones over the length of the longest token."""
        old, shift, behind, agreed = self.last, len(new) - (stop - start), start + len(new), 0
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[: start + 1]

        def settled(at: int) -> bool:
            nonlocal agreed
            agreed = agreed + 1 if at >= behind and self.last[at] == old[at - shift] else 0
            return agreed >= self.vocabulary.longest

        self._fill(start, settled)
        self.last += old[len(self.last) - shift :]

    def ids(self) -> list[int]:
        at, out, size = len(self.data), [], self.vocabulary.bytes_of
        while at:
            out.append(self.last[at])
            at -= len(size[out[-1]])
        return out[::-1]


# ------------------------------------------------------------------- splitting


@lru_cache(4)
def library_classes(pattern: str) -> tuple[str, str, str] | None:
    """Letters, numbers, and the characters whose class differs from this interpreter's pattern engine.

    The library's pattern engine keeps only what a pattern matches, so one pass over all characters
    of each class tells its Unicode tables. Each result is the inside of a bracketed class.
    """
    import regex
    import tiktoken

    everything = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    single = {bytes([b]): b for b in range(256)}
    theirs, differ = [], set()
    for name in (r"\p{L}", r"\p{N}"):
        probe = tiktoken.Encoding(f"probe {name}", pat_str=name, mergeable_ranks=single, special_tokens={})
        chars = set(bytes(probe.encode_ordinary(everything)).decode())
        theirs.append(chars)
        differ |= chars ^ set(regex.findall(name, everything))
    return _ranges(theirs[0]), _ranges(theirs[1]), _ranges(differ)


def _ranges(chars: set[str]) -> str:
    codes = np.array(sorted(map(ord, chars)), dtype=np.int64)
    if not len(codes):
        return ""
    cuts = np.flatnonzero(np.diff(codes) != 1)
    firsts, lasts = codes[np.r_[0, cuts + 1]], codes[np.r_[cuts, len(codes) - 1]]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(firsts, lasts))


class Splitter:
    """The pieces of a text, as the library behind the rank files cuts it."""

    def __init__(self, pattern: str, classes: tuple[str, str, str]):
        import regex

        letters, numbers, differ = classes
        self.usual = regex.compile(pattern)
        bare = {r"\p{L}": letters, r"\p{N}": numbers}
        self.exact = regex.compile(self._spelled(pattern, bare))
        try:  # the standard engine is faster where letters and numbers are those of ASCII
            self.ascii = re.compile(self._spelled(pattern, {r"\p{L}": "A-Za-z", r"\p{N}": "0-9"}), re.ASCII)
        except re.error:
            self.ascii = self.usual
        self.differ = frozenset(regex.findall(f"[{differ}]", "".join(map(chr, range(0x110000))))) if differ else frozenset()

    @staticmethod
    def _spelled(pattern: str, classes: dict[str, str]) -> str:
        """The pattern with its classes written out; inside brackets they need none of their own."""
        out, inside = [], False
        k = 0
        while k < len(pattern):
            name = pattern[k : k + 5]
            if name in classes:
                out.append(classes[name] if inside else f"[{classes[name]}]")
                k += 5
                continue
            step = 2 if pattern[k] == "\\" else 1
            if step == 1 and pattern[k] in "[]":
                inside = pattern[k] == "["
            out.append(pattern[k : k + step])
            k += step
        return "".join(out)

    def engine(self, text: str):
        if text.isascii():
            return self.ascii
        return self.usual if self.differ.isdisjoint(text) else self.exact

    def __call__(self, text: str) -> list[str]:
        return self.engine(text).findall(text)


class Encoder(dict):
    """encode(text) gives little-endian unsigned 32-bit ids; the mapping itself caches pieces' ids."""

    def __init__(self, path: str, pattern: str, classes: tuple[str, str, str]):
        super().__init__()
        self.vocabulary = Vocabulary(read_ranks(path))
        self.split = Splitter(pattern, classes)
        self.bytes_of = self.vocabulary.bytes_of

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.vocabulary.whole_only.get(data)
        ids = pack_ids(self.vocabulary.encode(data) if whole is None else [whole])
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def edit(self, text: str, ids: bytes, start: int, stop: int, new: str) -> tuple[str, bytes, int]:
        """Text and ids after putting new in place of characters [start, stop), and the number of bytes
        encoded for it. Pieces that end well before the edit keep their ids, and so does all that
        follows the first later place where old and new pieces begin alike."""
        changed, shift = text[:start] + new + text[stop:], len(new) - (stop - start)
        old_engine, engine = self.split.engine(text), self.split.engine(changed)
        # the three engines cut the same pieces, but the exact one where the others would not be exact
        same = (old_engine is self.split.exact) == (engine is self.split.exact)
        keep = 0
        begins = {0}
        for m in old_engine.finditer(text):
            begins.add(m.end())
            if m.end() + LOOKAHEAD <= start:
                keep = m.end()
        ends = np.cumsum([0, *(len(self.bytes_of[t]) for t in np.frombuffer(ids, "<u4").tolist())])

        def ids_before(position: int) -> int:
            return 4 * int(np.searchsorted(ends, len(text[:position].encode())))

        out, at, encoded = [ids[: ids_before(keep)]], keep, 0
        for m in engine.finditer(changed, keep):
            if m.start() >= start + len(new) and m.start() - shift in begins and same:
                break
            out.append(self[m.group()])
            encoded += len(m.group().encode())
            at = m.end()
        if at < len(changed):
            out.append(ids[ids_before(at - shift) :])
        return changed, b"".join(out), encoded


# ------------------------------------------------------------------- operators


def _encoder(path: str, pattern: str | None):
    """A function that makes an Encoder where it is called; the classes are asked for once, here."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    classes = library_classes(pattern)
    return lambda: Encoder(path, pattern, classes)


def _wider(df: DataFrame, name: str, kind: DataType) -> StructType:
    return StructType([*df.schema.fields, StructField(name, kind)])


def encode(docs: DataFrame, ranks: str, doc_id: str = "doc_id", text: str = "text", pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit) of every whole text, without special tokens.

    A null text is an empty one and has no ids. Repeated rows, null ids and rows of equal id are
    encoded each for itself; an empty table gives no rows; other columns are left out. ranks is the
    place of a rank file on every executor. A very long piece without a boundary takes time and
    memory in proportion to its length.
    """
    make = _encoder(ranks, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make()
        with no_cycle_search():
            for batch in batches:
                ids = [encoder.encode(t) for t in strings(batch.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), longs([len(x) // 4 for x in ids]), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"]
                )

    schema = f"doc_id {field_type(docs, doc_id)}, n_tokens bigint, ids binary"
    return picked(docs, doc_id=doc_id, text=text).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of encoded, and the bytes of the ids as `out`; null ids have null bytes.

    Bytes, as tokens may be cut inside a character. An id that the vocabulary does not have, or a
    binary that is no whole number of ids, is an error.
    """
    if out in encoded.columns:
        raise ValueError(f"there is a column {out} already")
    columns = encoded.columns
    place = columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = {rank: token for token, rank in read_ranks(ranks).items()}
        for batch in batches:
            data = [
                None if x is None else b"".join(map(bytes_of.__getitem__, np.frombuffer(x, "<u4").tolist()))
                for x in batch.column(place).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], [*columns, out])

    return encoded.mapInArrow(run, _wider(encoded, out, BinaryType()))


def edit(
    edits: DataFrame, ranks: str, text: str = "text", ids: str = "ids", start: str = "start", stop: str = "stop",
    new: str = "new", pattern: str | None = None,
) -> DataFrame:
    """All columns of edits, with text and ids after putting new in place of characters [start, stop), and
    bytes_encoded, the bytes that had to be encoded anew.

    Ids are exactly those of encoding the new text from the start. Positions beyond the text stand
    for its end, negative ones for its start; a null start or stop stands for the end, so rows with both null
    are appends. Null text, ids and new count as empty.
    """
    make = _encoder(ranks, pattern)
    columns = edits.columns
    at = [columns.index(c) for c in (text, ids, start, stop, new)]
    count = fresh(edits, "bytes_encoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make()
        for batch in batches:
            texts, all_ids, work = [], [], []
            for t, x, a, b, w in zip(*(batch.column(k).to_pylist() for k in at)):
                t, x, w = t or "", x or b"", w or ""
                a = len(t) if a is None else min(max(a, 0), len(t))
                b = len(t) if b is None else min(max(b, a), len(t))
                t, x, n = encoder.edit(t, x, a, b, w)
                texts.append(t)
                all_ids.append(x)
                work.append(n)
            out = list(batch.columns)
            out[at[0]], out[at[1]] = pa.array(texts, pa.string()), pa.array(all_ids, pa.binary())
            yield pa.RecordBatch.from_arrays([*out, longs(work)], [*columns, count])

    return edits.mapInArrow(run, _wider(edits, count, LongType()))
