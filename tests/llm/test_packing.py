import zlib

import numpy as np
import pytest
from helpers import AWKWARD, awkward, empty

from cartlens.llm import packing
from cartlens.llm.tokens import Encoder, vocabulary_path

PATH = vocabulary_path()


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 2047, 2048, 2049, 4097, 10_000])
def test_piece_lengths_are_powers_of_two(n):
    pieces = packing.piece_lengths(n, 2048)
    assert sum(pieces) == n and pieces == sorted(pieces, reverse=True)
    assert all(p & (p - 1) == 0 and p <= 2048 for p in pieces)
    small = [p for p in pieces if p < 2048]
    assert len(set(small)) == len(small)


def test_encoder_equals_tokenizer():
    e = Encoder(PATH)
    texts = [t or "" for _, t, _ in AWKWARD] + [
        "a\tb\x1cc   d", "<|endoftext|> x", "İΣ ΑΣ J̌ é ́x", "it's  we'LL 'Tis 12 ... a.b,c", "Été,  ÉTÉ!!", "x" * 5000,
    ]
    for t in texts + texts:
        assert e.encode(t) == e._whole(t)


def test_other_tokenizers_are_encoded_whole():
    e = Encoder(vocabulary_path("byte_bpe_50k.json"))
    assert not e.by_part
    assert e.encode("two  words\nhere") == e._whole("two  words\nhere")


def test_pieces_cover_every_id_once(spark):
    pieces = packing.decompose(awkward(spark, ids="x", bucket=1, START=2), PATH).collect()
    e = Encoder(PATH)
    expected = {}
    for doc_id, text, _ in AWKWARD:
        ids = e._whole(text or "") + packing.pack_ids([1])
        expected.setdefault(doc_id, []).append(ids)
    assert len({p["sequence_id"] for p in pieces}) == len(pieces)
    assert all(p["offset"] == 0 and p["length"] == 1 << p["bucket"] and len(p["ids"]) == 4 * p["length"] for p in pieces)
    by_doc = {}
    for p in sorted(pieces, key=lambda p: p["sequence_id"]):
        by_doc.setdefault(p["doc_id"], []).append(p)
    for doc_id, texts in expected.items():
        joined = b"".join(bytes(p["ids"]) for p in by_doc[doc_id])
        assert joined == b"".join(texts)
        assert {p["doc_tokens"] for p in by_doc[doc_id]} == {len(t) // 4 for t in texts}
    digests = {r["sequence_id"]: r["ids_crc32"] for r in packing.piece_digests(packing.decompose(awkward(spark), PATH)).collect()}
    assert digests == {p["sequence_id"]: zlib.crc32(bytes(p["ids"])) for p in pieces}


def test_buckets(spark, tmp_path):
    packing.write_buckets(packing.decompose(awkward(spark), PATH, max_length=64), str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b")).filter("bucket = 6").collect()
    assert back and all(len(np.frombuffer(bytes(r["ids"]), "<u4")) == 64 for r in back)


def test_empty_and_wrong(spark):
    assert packing.decompose(empty(spark), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.decompose(empty(spark), PATH, max_length=100)
