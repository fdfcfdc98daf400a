import random
import re

import numpy as np
import pytest
import xxhash
from helpers import AWKWARD, awkward, empty, got

from cartlens.llm import simhash
from cartlens.llm.components import components


def plain_print(text, shingle=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w]
    grams = [" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_of(prints, distance):
    """Smallest key reachable, by comparing all pairs."""
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(prints)
    values = np.array([prints[k] for k in keys], dtype=np.uint64)
    for i, k in enumerate(keys):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1 :]) <= distance):
            a, b = find(k), find(keys[i + 1 + int(j)])
            root[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("text", [t for _, t, _ in AWKWARD] + ["One two three", "ONE two\x0bthree  four FIVE É", "a b c d " * 30])
def test_fingerprint(text, monkeypatch):
    assert simhash.fingerprint(text or "") == plain_print(text)
    monkeypatch.setattr(simhash, "SPAN_WORDS", 5)
    short = " ".join((text or "").split(" ")[:300])
    assert simhash.fingerprint(short) == plain_print(short)


def random_prints(n, seed):
    """Clusters of fingerprints a few bits apart, in chains, and unrelated ones."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        out.append(rng.getrandbits(64))
        for _ in range(rng.choice([0, 0, 1, 5, 40])):
            flipped = out[-1]
            for b in rng.sample(range(64), rng.randint(1, 6)):
                flipped ^= 1 << b
            out.append(flipped)
    return {k + 1: v for k, v in enumerate(out[:n])}


@pytest.mark.parametrize("distance, bucket_rows, skewed", [(4, 50_000, False), (4, 40, True), (3, 25, False), (0, 50_000, True)])
def test_links_give_all_components(spark, distance, bucket_rows, skewed):
    prints = random_prints(1500, distance)
    if skewed:  # many bits nearly constant
        prints = {k: v & 0x0000FFFF0F0FFFFF for k, v in prints.items()}
    rows = [(k, int(np.uint64(v).astype(np.int64))) for k, v in prints.items()]
    classes = spark.createDataFrame(rows, "k bigint, fp bigint").select("fp").distinct().repartition(5)
    found = components(simhash.links(classes, distance, bucket_rows))
    root = {r["node"]: r["root"] for r in found.collect()}
    ours = {}
    for k, fp in rows:
        ours.setdefault(root.get(fp, fp), []).append(k)
    expected = {}
    for k, r in groups_of(prints, distance).items():
        expected.setdefault(r, []).append(k)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, expected.values()))


def test_parts_cover_the_distance():
    rng = np.random.default_rng(1)
    counts = rng.integers(1, 100, (16, 16)).astype(float)
    counts[:3, 1:] = 0  # constant bits
    for n in (10, 100_000, 10_000_000, 10_000_000_000):
        parts = simhash.choose_parts(counts, n, 4)
        assert sum(t + 1 for _, t in parts) == 5
        units = [u for p, _ in parts for u in p]
        assert len(set(units)) == len(units)
    few, many = (simhash.choose_parts(counts, n, 4) for n in (1000, 100_000_000))
    assert len(many) < len(few)  # wider parts, fewer candidates


def test_correlated_bits_share_a_unit():
    rng = np.random.default_rng(2)
    bits = rng.integers(0, 2, (4000, 64))
    for copy, source in ((40, 3), (50, 3), (60, 3)):
        bits[:, copy] = bits[:, source]
    order = simhash.correlated_order((bits.T @ bits).astype(float), len(bits))
    assert sorted(order) == list(range(64))
    assert len({order.index(b) // simhash.UNIT for b in (3, 40, 50, 60)}) == 1


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(k, k + 1) for k in range(500, 620)]
    edges += [(1000, 1000 + k) for k in range(1, 300)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    root = {}

    def find(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert found == {k: find(k) for e in edges for k in e if e[0] != e[1] or k in found}


def test_near_duplicates(spark):
    base = " ".join(f"w{k}" for k in range(400))
    near = base.replace("w7 ", "x7 ")
    rows = [(d, t) for d, t, _ in AWKWARD] + [(20, near), (21, base), (22, near), (23, "quite another text")]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, fp string, component_id int")
    found = got(simhash.near_duplicates(df), "doc_id", "fingerprint", "component_id")
    prints = {k: plain_print(t) for k, (_, t) in enumerate(rows)}
    groups = groups_of(prints, 4)
    members = {}
    for k, r in groups.items():
        members.setdefault(r, []).append(rows[k][0])
    least = {r: min((d for d in ds if d is not None), default=None) for r, ds in members.items()}
    assert found == sorted([(d, f"{prints[k]:016x}", least[groups[k]]) for k, (d, _) in enumerate(rows)], key=repr)


def test_deduplicate(spark):
    base = " ".join(f"w{k}" for k in range(400))
    rows = [(3, base, "a"), (1, base.replace("w7 ", "x7 "), "b"), (1, "something else here now", "c"), (9, base, "d"),
            (1, "something else here now", "c"), (30, "something else here now", "e"), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, found_id string")
    kept = got(simhash.deduplicate(df), "doc_id", "found_id")
    assert kept == sorted([(1, "b"), (1, "c"), (None, None)], key=repr)
    assert simhash.deduplicate(awkward(spark)).columns == ["doc_id", "text", "lang"]


def test_empty(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.deduplicate(empty(spark)).count() == 0
