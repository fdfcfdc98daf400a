import numpy as np
import pytest
from helpers import AWKWARD, awkward, empty

from cartlens.llm import binary_ids
from cartlens.llm.tokens import Encoder, vocabulary_path

PATH = vocabulary_path()


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000, 1025])
def test_segment_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint64).astype("<u4")
    payload = binary_ids.write_segment(ids, kind, block=64)
    assert (binary_ids.read_segment(payload) == ids).all()
    for a, b in ((0, 1), (60, 70), (63, 64), (n // 2, n), (n, n + 5)):
        assert (binary_ids.read_segment(payload, a, b) == ids[a:b]).all()


def test_planes_of_small_ids_vanish():
    ids = np.random.default_rng(1).integers(0, 49_000, 1 << 16).astype("<u4")
    assert len(binary_ids.write_segment(ids)) < 2.1 * len(ids)
    with pytest.raises(ValueError):
        binary_ids.read_segment(b"x" * 40)


@pytest.mark.parametrize("kind, segment", [("byte", 50), ("bit", 1 << 20)])
def test_files_hold_documents_in_order(spark, tmp_path, kind, segment):
    path = str(tmp_path / "ids")
    binary_ids.write_ids(awkward(spark, tie="x", shard=3), path, PATH, kind=kind, segment_ids=segment, block_ids=64)
    read = binary_ids.read_ids(spark, path).collect()
    e = Encoder(PATH)
    ids = {(d, e._whole(t or "") + binary_ids.pack_ids([2])) for d, t, _ in AWKWARD}
    assert len(read) == len(AWKWARD) and {(r["doc_id"], bytes(r["ids"])) for r in read} == ids
    at = 0
    for r in sorted(read, key=lambda r: r["start"]):
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(read, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))


def test_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    binary_ids.write_ids(empty(spark), path, PATH)
    assert binary_ids.document_digests(binary_ids.read_ids(spark, path)).count() == 0
