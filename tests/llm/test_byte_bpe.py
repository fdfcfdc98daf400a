import hashlib
import random

import public_tokenizers
import pytest
from helpers import AWKWARD, awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from cartlens.llm import byte_bpe, queries
from cartlens.llm.tokens import pack_ids

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library():
    import tiktoken

    ranks = byte_bpe.read_ranks(PATH)
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe._encoder(PATH, None)()


@pytest.fixture(scope="module")
def reference():
    return library()


def same(encoder, reference, text):
    return encoder.encode(text) == pack_ids(reference.encode_ordinary(text))


def test_awkward_texts(encoder, reference):
    texts = [t or "" for _, t, _ in AWKWARD] + ["it's we'll 'tis", "a\r\n\r\n  b  ", "\x1c\x85 x", "a" * 20_000, " " * 3000 + "x", "<|endoftext|>"]
    assert all(same(encoder, reference, t) for t in texts)


def test_characters_with_differing_tables(encoder, reference):
    differ = sorted(encoder.split.differ)
    assert differ  # otherwise the exact splitter is never needed
    r = random.Random(3)
    for _ in range(300):
        text = "".join(r.choice([r.choice(differ), "a", "1", " ", "!"]) for _ in range(12))
        assert same(encoder, reference, text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="abest 'lr\n\t12.…ß漢", max_size=80))
def test_random_texts(text):
    global _pair
    try:
        encoder, reference = _pair
    except NameError:
        _pair = encoder, reference = byte_bpe._encoder(PATH, None)(), library()
    assert same(encoder, reference, text)
    assert encoder.decode(encoder.encode(text)) == text.encode()


def test_prefixes_against_merging(encoder):
    """Every prefix's entry is the last token of that prefix merged by itself; appends and edits keep that."""
    v, r = encoder.vocabulary, random.Random(7)
    for _ in range(300):
        data = "".join(r.choice("the cat sat onß漢'12") for _ in range(r.randint(0, 30))).encode()
        cut = r.randint(0, len(data))
        table = byte_bpe.Prefixes(v, data[:cut])
        table.append(data[cut:])
        assert list(table.last[1:]) == [v.merge(data[:k])[-1] for k in range(1, len(data) + 1)]
        a = r.randint(0, len(data))
        b = r.randint(a, len(data))
        table.replace(a, b, b"xyz"[: r.randint(0, 3)])
        assert table.last == byte_bpe.Prefixes(v, table.data).last and table.ids() == v.merge(table.data)


def test_an_edit_touches_few_entries(encoder):
    table = byte_bpe.Prefixes(encoder.vocabulary, b" the cat sat on" * 400)
    before = table.computed
    table.replace(3000, 3002, b"xyz")
    assert before == 6000 and table.computed - before <= 3 * encoder.vocabulary.longest
    assert table.ids() == byte_bpe.Prefixes(encoder.vocabulary, table.data).ids()


def test_tokens_that_merging_never_makes():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abcd": 257}
    v = byte_bpe.Vocabulary(ranks)
    assert v.whole_only == {b"abcd": 257}
    assert byte_bpe.Prefixes(v, b"abcd").ids() == v.merge(b"abcd")
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary({b"a": 0})


def test_query_against_the_library(spark, folder, reference):
    got = {r["doc_id"]: r for r in queries.op13_prefix_bpe(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        text = d["text"] or ""
        ids = pack_ids(reference.encode_ordinary(text))
        row = got[d["doc_id"]]
        assert row["n_tokens"] == len(ids) // 4
        assert row["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_frames(spark, encoder):
    rows = byte_bpe.decode(byte_bpe.encode(awkward(spark, ids="x", n_tokens=1, DECODED=2), PATH), PATH).collect()
    assert sorted(((r["doc_id"], bytes(r["decoded"])) for r in rows), key=repr) == sorted(
        ((d, (t or "").encode()) for d, t, _ in AWKWARD), key=repr
    )
    assert byte_bpe.encode(empty(spark), PATH).count() == 0
    with pytest.raises(ValueError):
        byte_bpe.decode(spark.createDataFrame([(b"", 1)], "ids binary, decoded int"), PATH)


def test_edits_and_appends(spark, encoder):
    r, rows = random.Random(5), []
    for d, text, _ in AWKWARD[:4] + AWKWARD[5:]:
        for _ in range(12):
            t = text or ""
            a = r.choice([None, r.randint(-2, len(t) + 2)])
            b = r.choice([None, None if a is None else a + r.randint(0, 5)])
            rows.append((text, encoder.encode(t) if text else None, a, b, r.choice([None, "", " more", "'s", "  ", "é1"]), d))
    frame = spark.createDataFrame(rows, "text string, ids binary, start int, stop int, new string, bytes_encoded bigint")
    out = byte_bpe.edit(frame, PATH).collect()
    for (text, _, a, b, new, _), row in zip(rows, out):
        t = text or ""
        a = len(t) if a is None else min(max(a, 0), len(t))
        b = len(t) if b is None else min(max(b, a), len(t))
        assert row["text"] == t[:a] + (new or "") + t[b:]
        assert bytes(row["ids"]) == encoder.encode(row["text"])
    long = "one two three four " * 5000
    _, ids, work = encoder.edit(long, encoder.encode(long), 40_000, 40_003, "XYZ")
    assert ids == encoder.encode(long[:40_000] + "XYZ" + long[40_003:]) and work < 60


def test_which_tokens_may_follow(encoder):
    """The walk along both edges says the same as merging the two tokens' bytes, for random and for cut tokens."""
    v, r = encoder.vocabulary, random.Random(13)
    tokens = sorted(v.bytes_of)
    for k in range(20_000):
        left, right = r.choice(tokens), r.choice(tokens)
        if k % 2:  # tokens of one word
            data = v.bytes_of[left] + v.bytes_of[right][:3]
            cut = r.randint(1, len(data) - 1)
            left, right = v.merge(data[:cut])[-1], v.merge(data[cut:])[0]
        assert v.fits(left, right) == (v.merge(v.bytes_of[left] + v.bytes_of[right]) == [left, right])


def test_ranks_out_of_order():
    single = {bytes([b]): b for b in range(256)}
    byte_bpe.Vocabulary(single | {b"ab": 256, b"bc": 257, b"abc": 258})
    with pytest.raises(ValueError, match="order"):
        byte_bpe.Vocabulary(single | {b"abc": 256, b"ab": 257})


def test_small_vocabularies():
    """Every string of random merge orders over three letters, against merging."""
    r = random.Random(17)
    for _ in range(25):
        made = [b"a", b"b", b"c"]
        while len(made) < 16:
            new = r.choice(made) + r.choice(made)
            if new not in made and len(new) <= 6:
                made.append(new)
        try:
            v = byte_bpe.Vocabulary({bytes([b]): b for b in range(256)} | {t: 256 + k for k, t in enumerate(made[3:])})
        except ValueError:
            continue
        for _ in range(300):
            data = bytes(r.choice(b"abc") for _ in range(r.randint(1, 14)))
            if data not in v.whole_only:
                assert byte_bpe.Prefixes(v, data).ids() == v.merge(data)
