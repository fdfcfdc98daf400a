"""Toxicity by maximum-scoring segments.

Tokens are words and, for words that are rare, their stems (the first STEM_BYTES bytes). They get the
log-odds of occurring in toxic against other labelled documents, with an informative Dirichlet prior
from both classes together, minus a drift that makes ordinary text score below zero on average. All maximal scoring segments of a document are found in one linear scan; each
is a passage. A segment of score s in n tokens is judged by extreme-value statistics: for random
ordinary text the best segment exceeds s with probability 1 - exp(-K n exp(-lambda s)), where
lambda solves E[exp(lambda score)] = 1 over ordinary tokens and K is fitted to the best segments of
ordinary documents. Passages that are rare by this measure are significant, and their surprisal
adds up to the document's evidence, which a logistic fit turns into a score from 0 to 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.llm.common import field_type, fresh, picked, strings
from cartlens.session import materialize

# Bound of the labelled rows a model is fitted on, per class.
FIT_ROWS = 20_000
PRIOR = 50.0
DRIFT = 1.0
HIGHEST = 8.0
MIN_Z = 4.0
STEM_BYTES = 4
SIGNIFICANCE = 0.05
SPAN = 1 << 20

# ASCII letters to lower case, other ASCII but digits to a space; bytes above 127 belong to words
BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b > 127 else 32 for b in range(256)
)


def words_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text, a span at a time; a word is never cut."""
    data = text.encode("utf-8", "surrogatepass").translate(BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SPAN)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def maximal_segments(places: list[int], scores: list[float], step: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last place) in one scan.

    Only tokens with a positive score are listed, with their places; every other token between
    them counts `step` (below zero). A candidate list with cumulative sums is kept; a new token joins
    backwards while it raises the score of what it joins.
    """
    kept: list[list] = []  # first place, last place, sum before, sum after
    total, last = 0.0, 0
    for place, score in zip(places, scores):
        total += step * (place - last)
        last = place + 1
        first, before, after = place, total, total + score
        while kept:
            k = len(kept) - 1
            while k >= 0 and kept[k][2] >= before:
                k = kept[k][4]
            if k < 0 or kept[k][3] >= after:
                break
            first, before = kept[k][0], kept[k][2]
            del kept[k:]
        # the nearest earlier segment that starts lower, found through the links of those passed over
        link = len(kept) - 1
        while link >= 0 and kept[link][2] >= before:
            link = kept[link][4]
        kept.append([first, place, before, after, link])
        total = after
    return [(after - before, first, last) for first, last, before, after, _ in kept]


@dataclass
class Model:
    scores: dict[bytes, float]  # words
    stems: dict[bytes, float]
    step: float  # score of every other word
    decay: float  # lambda
    size: float  # K
    weights: tuple[float, float, float, float]

    def segments(self, text: str) -> tuple[int, list[tuple[float, int, int]]]:
        """Number of words, and all maximal segments in order."""
        n, places, scores = self.scored(text)
        return n, maximal_segments(places, scores, self.step)

    def scored(self, text: str) -> tuple[int, list[int], list[float]]:
        """Number of words, and place and score of those that count for toxicity."""
        word, stem, n, places, scores = self.scores.get, self.stems.get, 0, [], []
        for words in words_of(text):
            found = [word(w) or stem(w[:STEM_BYTES]) for w in words]
            for k, s in enumerate(found):
                if s is not None:
                    places.append(n + k)
                    scores.append(s)
            n += len(words)
        return n, places, scores

    def surprisal(self, score: float, n: int) -> float:
        """-log of the chance that ordinary text of n words has a segment this good."""
        expected = self.size * max(n, 1) * math.exp(-self.decay * score)
        chance = -math.expm1(-expected)
        return -math.log(max(chance, 1e-300))

    def features(self, text: str) -> tuple[np.ndarray, int, list[tuple[float, int, int]]]:
        n, found = self.segments(text)
        judged = [(self.surprisal(s, n), first, last) for s, first, last in found]
        passages = [x for x in judged if x[0] >= -math.log(SIGNIFICANCE)]
        best = max((x[0] for x in judged), default=0.0)
        raw = max((s for s, _, _ in found), default=0.0)
        return np.array([1.0, best, math.log1p(sum(x[0] for x in passages)), raw]), n, passages

    def score(self, text: str) -> tuple[float, list[tuple[float, int, int]]]:
        x, _, passages = self.features(text)
        z = float(np.clip(x @ np.array(self.weights), -35, 35))
        return 1 / (1 + math.exp(-z)), passages


def _shared(spark: SparkSession, model: Model):
    """Broadcast of a model as plain values; its words are those of a bounded sample."""
    return spark.sparkContext.broadcast(dict(vars(model)))


def _sample(labelled: DataFrame, rows: int) -> DataFrame:
    """At most `rows` documents of each class, taken by a hash of the id; the ids of the chosen are
    bounded by 2 * rows, so they may be broadcast."""
    ids = labelled.select("doc_id", "toxic")
    chosen = []
    for c in (0, 1):
        mine = ids.filter(F.col("toxic") == c)
        # a large class is thinned by a hash to a few times what is wanted before its ids meet
        n = max(1, mine.count())
        thinned = mine.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(n)) < 4 * rows)
        chosen.append(thinned.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return chosen[0].unionByName(chosen[1])


def _decay(clean: DataFrame, model: Model) -> float:
    """lambda: the positive root of E[exp(lambda score)] = 1 over the words of ordinary documents.

    The number of distinct scores is bounded by the model's words. Each counts half a word more than it was
    seen, so that scores not seen in ordinary text do not make it unbounded."""
    shared = _shared(clean.sparkSession, model)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        known, seen = Model(**shared.value), Counter()
        for batch in batches:
            for t in strings(batch.column(0)):
                n, _, scores = known.scored(t)
                seen.update(scores)
                seen[known.step] += n - len(scores)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen.keys()), pa.float64()), pa.array(list(seen.values()), pa.int64())], ["score", "n"]
        )

    rows = clean.select("text").mapInArrow(tally, "score double, n bigint").groupBy("score").agg(F.sum("n").alias("n"))
    seen = {r["score"]: float(r["n"]) for r in rows.collect()}
    for s in [*model.scores.values(), *model.stems.values()]:
        seen[s] = seen.get(s, 0.0) + 0.5
    values, weights = np.array([*seen, model.step]), np.array([*seen.values(), 1.0])
    weights /= weights.sum()
    if values @ weights >= 0:  # more toxic than ordinary words in ordinary text: only very high scores will count
        return 1e-3
    low, high = 0.0, 1.0
    while weights @ np.exp(high * values) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if weights @ np.exp(middle * values) < 1 else (low, middle)
    return max(high, 1e-3)


def _newton(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Logistic regression with a ridge, by Newton steps that are halved until they help."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[0] = 1.0
    z = x / scale
    ridge = penalty * np.eye(x.shape[1])
    ridge[0, 0] = 1e-3

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, z @ w).sum() - y @ (z @ w) + w @ ridge @ w / 2)

    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        slope = z.T @ (p - y) + ridge @ w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, slope)
        size, now = 1.0, loss(w)
        while loss(w - size * step) > now and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w / scale


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    usable: Column | None = None,
    fit_rows: int = FIT_ROWS,
) -> Model:
    """Learn from labelled documents (labels: doc_id, toxic 0/1; other values are left out).

    usable: a condition on a column doc_id that the labels must meet. At most fit_rows documents of
    each class are used; of rows that share an id, the text that sorts first. Texts that are equal but for case
    and white space count once for each class. Without documents of both classes the model scores every text 0.
    """
    spark = docs.sparkSession
    known = labels.select("doc_id", "toxic").filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    if usable is not None:
        known = known.filter(usable)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = materialize(_sample(known, fit_rows), "toxic-sample")
    sample = picked(docs, doc_id=doc_id, text=text).join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    # copies of a labelled text are one observation
    same = F.sha2(F.lower(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " "))), 256)
    sample = sample.groupBy(same.alias("same"), "toxic").agg(F.min("text").alias("text"))
    sample = materialize(sample.select("text", F.col("toxic").cast("int")), "toxic-texts")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Model({}, {}, -1.0, 1.0, 1.0, (-35.0, 0.0, 0.0, 0.0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        total = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            tokens = list(total[0].keys() | total[1].keys())
            columns = [pa.array([k for k, _ in tokens]), pa.array([t for _, t in tokens], pa.binary())]
            columns += [pa.array([t[w] for w in tokens], pa.int64()) for t in total]
            return pa.RecordBatch.from_arrays(columns, ["stem", "token", "clean", "toxic"])

        for batch in batches:
            for t, c in zip(strings(batch.column(0)), batch.column(1).to_pylist()):
                seen = {w for words in words_of(t) for w in words}
                total[c].update((False, w) for w in seen)
                total[c].update({(True, w[:STEM_BYTES]) for w in seen})
            if len(total[0]) + len(total[1]) > 500_000:
                yield out()
                total = (Counter(), Counter())
        if total[0] or total[1]:
            yield out()

    # documents with each token; occurrences in one document depend on each other
    counts = sample.mapInArrow(count, "stem boolean, token binary, clean bigint, toxic bigint")
    counts = counts.groupBy("stem", "token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n_clean, n_toxic = float(sizes[0]), float(sizes[1])
    prior = F.lit(PRIOR) * (F.col("clean") + F.col("toxic")) / F.lit(n_clean + n_toxic)

    def odds(column: str, size: float) -> Column:
        mine = F.col(column) + prior
        return F.log(mine / (F.lit(size + PRIOR + 1) - mine))

    value = odds("toxic", n_toxic) - odds("clean", n_clean)
    spread = 1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior)
    rated = counts.select("stem", "token", value.alias("value"), (value / F.sqrt(spread)).alias("z"))
    rated = rated.filter((F.col("value") > DRIFT) & (F.col("z") > MIN_Z))
    rows = rated.collect()  # words of the bounded sample that are significantly toxic
    scores, stems = (
        {bytes(r["token"]): min(r["value"], HIGHEST) - DRIFT for r in rows if r["stem"] == kind} for kind in (False, True)
    )
    model = Model(scores, stems, -DRIFT, 1.0, 1.0, (0.0, 0.0, 0.0, 0.0))
    model.decay = _decay(sample.filter("toxic = 0"), model)
    shared = _shared(spark, model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**shared.value)
        for batch in batches:
            best, size = [], []
            for t in strings(batch.column(0)):
                words, found = known.segments(t)
                best.append(max((s for s, _, _ in found), default=0.0))
                size.append(words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(best, pa.float64()), pa.array(size, pa.int64())], ["toxic", "best", "words"]
            )

    best = sample.mapInArrow(measure, "toxic int, best double, words bigint").filter("toxic = 0 and words > 0")
    # log K: the mean of lambda * best - log n is log K plus Euler's constant; the median is used instead, so
    # that toxic passages in mislabelled documents do not count. -log(log 2) is the median of the law.
    centre = best.select(F.median(F.lit(model.decay) * F.col("best") - F.log("words")).alias("m")).first()["m"]
    model.size = math.exp(min(max((centre or 0.0) + math.log(math.log(2)), -30.0), 30.0))

    calibrated = _shared(spark, model)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**calibrated.value)
        for batch in batches:
            x = np.array([known.features(t)[0] for t in strings(batch.column(0))]).reshape(-1, 4)
            columns = [pa.array(np.ascontiguousarray(x[:, k])) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(1), *columns], ["toxic", "a", "b", "c", "d"])

    # at most 2 * fit_rows rows of five numbers
    rows = sample.mapInArrow(describe, "toxic int, a double, b double, c double, d double").toPandas()
    x, y = rows[["a", "b", "c", "d"]].to_numpy(), rows["toxic"].to_numpy(dtype=float)
    model.weights = tuple(float(w) for w in _newton(x, y))
    return model


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, score (0 to 1), predicted (1 from 0.5 on), n_words, passages (significant
    segments as first and last word and surprisal).

    A null or empty text has no words and gets the score of a text without any segment. The model's
    words are those of a bounded sample. Map-only.
    """
    shared = _shared(docs.sparkSession, model)
    passage = pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("surprisal", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**shared.value)
        for batch in batches:
            results = [known.score(t) for t in strings(batch.column(1))]
            spans = [[{"first_word": a, "last_word": b, "surprisal": s} for s, a, b in p] for _, p in results]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([s for s, _ in results], pa.float64()),
                    pa.array([int(s >= 0.5) for s, _ in results], pa.int32()),
                    pa.array(spans, pa.list_(passage)),
                ],
                ["doc_id", "score", "predicted", "passages"],
            )

    kind = field_type(docs, doc_id)
    passages = "array<struct<first_word:bigint,last_word:bigint,surprisal:double>>"
    return picked(docs, doc_id=doc_id, text=text).mapInArrow(
        run, f"doc_id {kind}, score double, predicted int, passages {passages}"
    )


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs without those predicted toxic; all columns, map-only."""
    shared = _shared(docs.sparkSession, model)

    @F.pandas_udf("boolean")
    def clean(texts):
        import pandas as pd

        known = Model(**shared.value)
        return pd.Series([known.score(t or "")[0] < 0.5 for t in texts], dtype=bool)

    name = fresh(docs, "clean")
    return docs.withColumn(name, clean(docs[text])).filter(F.col(name)).drop(name)
