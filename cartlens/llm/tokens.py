"""Token ids of whole texts, with a cache of the parts between spaces."""

from __future__ import annotations

import array
import os
import re
import sys

CACHE_ENTRIES = 400_000
SPAN_CHARS = 1_000_000

# one Latin word with punctuation behind it; no combining marks, no apostrophe
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-&(-/:-@\\[-`{-~]*)")
PROBES = ("word other", "x1  ...", "it's\n2nd", "Olé, ÉTÉ.", "schnell!! (auf)", "ab.cd,")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Place of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pack_ids(ids) -> bytes:
    """Little-endian unsigned 32-bit."""
    out = array.array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Encoder:
    """encode(text) gives little-endian unsigned 32-bit ids, without added special tokens.

    A tokenizer that drops white space treats the parts between spaces independently, so their ids
    are looked up once and kept; a plain word with punctuation goes straight to the tokenizer's
    model. Whether a tokenizer works like this is probed. The special tokens' own strings can only
    be seen in a whole text; such texts, and other tokenizers, are encoded whole. The cache keeps
    two generations of CACHE_ENTRIES parts, which bounds a worker's memory.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bytes_as_text = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.by_part = all(
            self._whole(p) == b"".join(map(self._whole, p.split())) and self._whole(p.upper()) == self._whole(p)
            for p in PROBES
        )
        if self.by_part:
            self.by_part = all(self._part(w) == self._whole(w) for p in PROBES for w in p.split())

    def _whole(self, text: str) -> bytes:
        return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = self.bytes_as_text(word)[0][0]
        return pack_ids([t.id for t in self.model.tokenize(word)])

    def _part(self, part: str) -> bytes:
        if part.isalpha() and part.isascii():
            return self._word(part.lower())
        plain = PLAIN.fullmatch(part)
        if not plain:
            return self._whole(part)
        word, tail = plain.groups()
        if not tail:
            return self._word(word.lower())
        ids = self.tails.get(tail)
        if ids is None:
            ids = self.tails[tail] = self._word(tail)
            if len(self.tails) > 10_000:
                self.tails.clear()
        return self._missing(word.lower()) + ids

    def _missing(self, part: str) -> bytes:
        ids = self.young.get(part) or self.old.get(part)
        if ids is None:
            ids = self._part(part)
        self.young[part] = ids
        return ids

    def _span(self, text: str) -> bytes:
        # lower case of plain ASCII is what the tokenizer does itself, and makes fewer different parts
        parts = (text.lower() if text.isascii() else text).replace("\n", " ").split(" ")
        get = self.young.get
        found = list(map(get, parts))
        if None in found:
            found = [self._missing(p) if ids is None else ids for p, ids in zip(parts, found)]
            if len(self.young) > CACHE_ENTRIES:
                self.old, self.young = self.young, {"": b""}
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        if not self.by_part or any(s in text for s in self.special):
            return self._whole(text)
        if len(text) <= SPAN_CHARS:
            return self._span(text)
        out, at = [], 0
        while at < len(text):
            end = text.find(" ", at + SPAN_CHARS)
            end = len(text) if end < 0 else end
            out.append(self._span(text[at:end]))
            at = end
        return b"".join(out)
