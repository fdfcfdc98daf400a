import random

import numpy as np
import pytest
from helpers import AWKWARD, awkward, empty, got
from pyspark.sql import functions as F

from cartlens.llm import toxicity


def by_definition(scores):
    """Maximal scoring segments by their recursive definition: the best segment, then both sides."""
    out = []

    def part(a, b):
        sums = np.concatenate([[0.0], np.cumsum(scores[a:b])])
        best, place = 1e-12, None
        for i in range(b - a):
            for j in range(i + 1, b - a + 1):
                s = sums[j] - sums[i]
                # ties: the shortest and first
                if s > best + 1e-9:
                    best, place = s, (i, j)
        if place:
            i, j = place
            part(a, a + i)
            out.append((round(float(best), 6), a + i, a + j - 1))
            part(a + j, b)

    part(0, len(scores))
    return sorted(out, key=lambda x: x[1])


@pytest.mark.parametrize("seed", range(30))
def test_segments(seed):
    rng = random.Random(seed)
    n = rng.randrange(0, 40)
    positive = sorted(rng.sample(range(n), rng.randint(0, n))) if n else []
    values = [rng.uniform(0.1, 4) for _ in positive]
    dense = np.full(n, -0.97)
    dense[positive] = values
    found = [(round(s, 6), a, b) for s, a, b in toxicity.maximal_segments(positive, values, -0.97)]
    assert found == by_definition(dense)


def test_words_across_spans(monkeypatch):
    monkeypatch.setattr(toxicity, "SPAN", 7)
    text = "One two-three, FOUR  é5 six seven eightnineten x"
    assert [w for ws in toxicity.words_of(text) for w in ws] == [
        b"one", b"two", b"three", b"four", "é5".encode(), b"six", b"seven", b"eightnineten", b"x",
    ]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(9)
    plain = [f"{a}{b}" for a in "bcdfgh" for b in ("alo", "eri", "ino", "oma", "utu")]
    rude = ["vilest", "grubby", "rotten"]
    rows = []
    for k in range(1200):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 200))]
        toxic = int(k % 5 == 0)
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = [f"{rng.choice(rude)}{rng.choice(['', 'ly', 'ness'])}" for _ in range(4)]
        rows.append((k, " ".join(words), toxic))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(3).cache()
    return df, toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"), usable=F.col("doc_id") % 4 != 0)


def test_held_out_accuracy(corpus):
    df, model = corpus
    rows = toxicity.score(df.filter("doc_id % 4 = 0"), model).join(df.select("doc_id", "toxic"), "doc_id").collect()
    assert len(rows) == 300 and sum(r["predicted"] == r["toxic"] for r in rows) >= 295
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_passages_are_where_the_words_are(corpus):
    _, model = corpus
    text = "balo ceri dino " * 20 + "vilest grubby rotten " + "fuma gutu hino " * 20
    _, passages = model.score(text)
    assert [(a, b) for _, a, b in passages] == [(60, 62)]


def test_keep_clean(corpus):
    df, model = corpus
    more = df.withColumn("clean", F.lit("x"))
    kept = toxicity.keep_clean(more, model)
    assert kept.columns == more.columns
    clean = toxicity.score(df, model).filter("predicted = 0").select("doc_id")
    assert got(kept, "doc_id") == got(clean, "doc_id")


def test_awkward_rows(spark, corpus):
    _, model = corpus
    rows = got(toxicity.score(awkward(spark, score=1, toxic=0), model), "doc_id", "score", "predicted")
    assert len(rows) == len(AWKWARD) and all(p == 0 and 0 <= s < 0.5 for _, s, p in rows)
    assert toxicity.score(empty(spark), model).count() == 0


def test_labels_of_one_class_or_none(spark, corpus):
    df, _ = corpus
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 7), (3, 0)], "doc_id bigint, toxic int")
    for labels in (none, odd):
        model = toxicity.fit(df, labels)
        assert toxicity.score(df.limit(5), model).agg(F.max("score")).first()[0] < 1e-6
