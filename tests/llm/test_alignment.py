import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from helpers import AWKWARD, awkward, empty

from cartlens.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(A, B)


def plain(aligner, text):
    """Ids with byte ranges, by position: links as all overlapping pairs, groups between common ends."""
    got = aligner.tokens(text) if text else None
    if not got:
        return [], [], [], []
    a, b, a_sizes, b_sizes = got
    ranges = []
    for sizes in (a_sizes, b_sizes):
        at, out = 0, []
        for s in sizes:
            out.append((at, at + s))
            at += s
        ranges.append(out)
    links = [(x, y) for x, (s, e) in zip(a, ranges[0]) for y, (u, w) in zip(b, ranges[1]) if s < w and u < e]
    cuts = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
    groups, start = [], 0
    for c in cuts:
        groups.append(tuple([t for t, (s, e) in zip(ids, r) if start <= s and e <= c] for ids, r in zip((a, b), ranges)))
        start = c
    return a, b, groups, links


def brute(aligner, texts):
    """The figures of every text."""
    parts = [plain(aligner, t) for t in texts]
    counts = Counter(p for *_, links in parts for p in links)
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for a, b, groups, links in parts:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        best = sum(counts[p] == top[p[1]] for p in links)
        out.append((len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return out, counts, top


def figures(rows):
    return sorted(((r["doc_id"], *(r[c] for c in FIGURES)) for r in rows), key=repr)


def test_token_bytes_spell_texts(aligner):
    assert aligner.by_part and not aligner.b.joins_at_cuts
    assert aligner.a.bytes_of[aligner.a.encode([""])[0][0]] == b" "
    for text in ("plain", "it's <|endoftext|> <s> <unk> <0x41>", "漢字 ß\0\t\x7f 😀", "  "):
        assert aligner.tokens(text) is not None
    for text in ("", "a ▁ b"):
        assert aligner.tokens(text) is None


def test_groups_and_links_by_hand():
    assert alignment.split_groups([2, 3, 1], [1, 1, 2, 2]) == [(0, 1, 0, 2), (1, 3, 2, 4)]
    assert alignment.expand_links([2, 3, 1], [1, 1, 2, 2], (1, 3, 2, 4)) == [(1, 2), (1, 3), (2, 3)]
    assert alignment.split_groups([], []) == []


def test_parts_equal_whole_texts(aligner):
    whole = alignment.Aligner(A, B)
    whole.by_part = False
    r = random.Random(11)
    for _ in range(3000):
        text = "".join(r.choice("abst 's  \n\n\t..,)!12é▁<>漢\x1c　") for _ in range(r.randint(0, 30)))
        p, q = aligner.align(text), whole.align(text)
        assert p[:5] == q[:5] and p[5].tolist() == q[5].tolist(), text


@pytest.mark.parametrize("frequent", [1, 40, 1 << 20])
def test_figures_against_brute_force(spark, aligner, frequent):
    r = random.Random(frequent)
    words = ["the", "cat", "thonest", "ünïted", "漢字", "sat.\nOn", "▁x", "12,000", "it's", "  "]
    texts = [" ".join(r.choice(words[: 6 + 4 * (k % 2)]) for _ in range(r.randint(0, 40))) for k in range(60)] + [None, "", "the", "the"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = alignment.align_documents(frame, A, B, frequent_pairs=frequent).collect()
    expected = brute(aligner, [t or "" for t in texts])[0]
    assert figures(got) == sorted([(k, *f) for k, f in enumerate(expected)], key=repr)


def test_pair_counts(spark, aligner, monkeypatch):
    monkeypatch.setattr(alignment, "FLUSH_LINKS", 50)
    texts = [t for _, t, _ in AWKWARD[:4] + AWKWARD[5:]]
    got = alignment.link_counts(awkward(spark, pair=1, n=2).filter("doc_id <> 5 or doc_id is null"), A, B).collect()
    _, counts, top = brute(aligner, [t or "" for t in texts])
    assert {(r["a"], r["b"]): (r["n"], r["best"]) for r in got} == {p: (n, n == top[p[1]]) for p, n in counts.items()}


def test_group_rows(spark, aligner):
    rows = alignment.groups(awkward(spark, place="x").filter("doc_id in (1, 4, 7)"), A, B).orderBy("doc_id", "place").collect()
    for d, text, _ in AWKWARD:
        if d in (1, 4, 7):
            mine = [r for r in rows if r["doc_id"] == d]
            data = (" " + text).encode()
            assert b"".join(data[r["start"] : r["stop"]] for r in mine) == data
            for r in mine:
                for ids, side in ((r["a_ids"], aligner.a), (r["b_ids"], aligner.b)):
                    assert b"".join(side.bytes_of[k] for k in ids) == data[r["start"] : r["stop"]]


def test_awkward_rows(spark, aligner):
    got = alignment.align_documents(awkward(spark, pairs="x", doc_row=1, BEST=2), A, B).collect()
    assert len(got) == len(AWKWARD)
    zero = {r["doc_id"] for r in got if r["n_links"] == 0}
    assert zero == {2, 3}
    twins = [tuple(r) for r in got if r["doc_id"] == 6]
    assert len(twins) == 2 and twins[0] == twins[1]
    assert alignment.align_documents(empty(spark), A, B).count() == 0


def test_query_against_brute_force(spark, folder, aligner):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    short = {d["doc_id"]: d["text"] or "" for d in docs}
    got = {r["doc_id"]: r for r in queries.op12_alignment(spark, folder).collect()}
    assert got.keys() == short.keys()
    # overlaps by walking both end lists instead of grouping
    counts, parts = Counter(), {}
    for d, text in short.items():
        tokens = aligner.tokens(text)
        links = []
        if tokens:
            a, b, a_sizes, b_sizes = tokens
            owner, at = [], 0
            for k, s in enumerate(b_sizes):
                owner += [k] * s
            for x, s in zip(a, a_sizes):
                links += [(x, b[k]) for k in dict.fromkeys(owner[at : at + s])]
                at += s
        parts[d] = links
        counts.update(links)
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    for d, links in parts.items():
        r = got[d]
        assert (r["n_links"], r["count_sum"]) == (len(links), sum(counts[p] for p in links))
        assert r["n_best"] == sum(counts[p] == top[p[1]] for p in links)
