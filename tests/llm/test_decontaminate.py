import hashlib
import random
import re

import pytest
from helpers import AWKWARD, awkward, empty, got

from cartlens.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    grams = {}
    for i, t in items:
        w = words(t)
        n = min(len(w), window)
        for k in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    sizes = {len(g) for g in grams}
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in grams:
                    hit.update(range(k, k + n))
                    found |= grams[tuple(w[k : k + n])]
        ids = ",".join(sorted(found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(60)] + ["Été", "ß", "漢"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.choice([1, 2, 5, 13, 14, 30]))) for k in range(9)]
    items += [(90, items[-1][1]), (91, None), (92, "... !"), (93, "W1, w2; w3 W4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14")]
    # equal first, middle and last words, different ones between
    items += [(94, "a b c d e f g h i j k l m"), (95, "a x c d e f g h i j k l m")]
    docs = [(d, t) for d, t, _ in AWKWARD]
    for k in range(40):
        i = rng.choice(items)[1] or ""
        docs.append((100 + k, f"{text(rng.randrange(40))}. {i.upper() if k % 2 else i} {i} {text(rng.randrange(300))}"))
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame([(*r, "x", 7) for r in docs], "doc_id bigint, text string, gram string, n_hit int")
    return d, spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("most", [500_000, 20])
def test_equals_brute_force(spark, planted, most):
    docs, items = frames(spark, *planted)
    found = decontaminate.find(docs, items, broadcast_windows=most)
    assert got(found, *COLUMNS) == brute(*planted)


def test_one_length_only(spark, planted):
    docs = planted[0]
    items = [(1, " ".join(f"w{k}" for k in range(20)))]
    docs = docs + [(900, "x " + items[0][1] + " y")]
    d, i = frames(spark, docs, items)
    assert got(decontaminate.find(d, i), *COLUMNS) == brute(docs, items)


def test_removal(spark, planted):
    docs, items = frames(spark, *planted)
    bad = {r[0] for r in brute(*planted) if r[5]}
    kept = decontaminate.remove_documents(docs, items)
    assert kept.columns == docs.columns
    assert got(kept, "doc_id") == sorted([(d,) for d, _ in planted[0] if d not in bad], key=repr)
    cleaned = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, items).collect()}
    for d, t in planted[0]:
        n_hit = next(r[2] for r in brute([(d, t)], planted[1]))
        assert len(words(cleaned[d])) == len(words(t)) - n_hit
        if not n_hit:
            assert cleaned[d] == t


def test_empty(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.find(empty(spark), none).count() == 0
    assert decontaminate.remove_documents(awkward(spark), none).count() == len(AWKWARD)
    assert got(decontaminate.find(awkward(spark), none), "n_hit") == [(0,)] * len(AWKWARD)


def test_stays_native(spark, planted):
    docs, items = frames(spark, *planted)
    plan = decontaminate.find(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan
