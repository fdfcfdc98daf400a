"""Language identification with string kernels.

A text is the set of its character n-grams, n from 1 to ORDERS (blended spectrum, presence), hashed
into FEATURES cells. The kernel of two texts is the number of n-grams they share, divided by the root
of the product of their numbers. A few landmark texts give a Nyström map of that kernel, on which
one ridge regression per language (one against the rest) is solved. As the kernel is linear in the
presence of n-grams, landmarks and weights are multiplied out once, and a batch of texts is
scored by one matrix product of their presence matrix with that table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlens.llm.common import field_type, picked, strings
from cartlens.session import materialize

ORDERS = 4
FEATURE_BITS = 18
FEATURES = 1 << FEATURE_BITS
# Bounds of the labelled rows the classifier is fitted on.
FIT_ROWS = 4000
LANDMARKS = 256
RIDGE = 1e-3
SHARPNESS = 4.0
BATCH = 64
SPAN = 1 << 20
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def present(text: str, table: np.ndarray) -> np.ndarray:
    """Sorted cells of the text's n-grams; table is scratch space of FEATURES zeros."""
    lowered = text.lower()
    for at in range(0, max(len(lowered), 1), SPAN):
        # spans overlap, so that no n-gram is lost between them
        span = lowered[at : at + SPAN + ORDERS - 1]
        points = np.frombuffer(span.encode("utf-32-le", "surrogatepass"), "<u4")
        key = np.zeros(len(points) + 1, np.uint32)
        for n in range(1, ORDERS + 1):
            if len(points) < n:
                break
            key = (key[: len(points) - n + 1] + np.uint32(n)) * np.uint32(0x9E3779B1) + points[n - 1 :]
            mixed = (key ^ (key >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            table[mixed >> np.uint32(32 - FEATURE_BITS)] = 1
    cells = np.flatnonzero(table)
    table[cells] = 0
    return cells


@dataclass
class Model:
    languages: list[str]
    column: np.ndarray  # cell -> row of weights, or -1
    weights: np.ndarray  # n-grams of the landmarks x languages
    bias: np.ndarray

    def score(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        scratch = np.zeros(FEATURES, np.uint8)
        for at in range(0, len(texts), BATCH):
            some = texts[at : at + BATCH]
            seen = np.zeros((len(some), len(self.weights)), np.float32)
            size = np.ones(len(some))
            for k, t in enumerate(some):
                cells = present(t, scratch)
                size[k] = max(len(cells), 1)
                rows = self.column[cells]
                seen[k, rows[rows >= 0]] = 1
            values = (seen @ self.weights) / np.sqrt(size)[:, None] + self.bias
            share = np.exp(SHARPNESS * (values - values.max(axis=1, keepdims=True)))
            share /= share.sum(axis=1, keepdims=True)
            for t, v in zip(some, share):
                known = LETTER.search(t) is not None
                names.append(self.languages[int(np.argmax(v))] if known else UNKNOWN)
                scores.append(float(v.max()) if known else 0.0)
        return names, scores


def _solve(languages: list[str], cells: list[np.ndarray]) -> Model:
    classes = sorted(set(languages))
    turn: dict[str, int] = {}
    order = []
    for k, name in enumerate(languages):
        turn[name] = turn.get(name, 0) + 1
        order.append((turn[name], k))
    marks = [k for _, k in sorted(order)[:LANDMARKS]]  # the same number of each language, as far as there are
    used = np.unique(np.concatenate([cells[k] for k in marks]))
    column = np.full(FEATURES, -1, np.int32)
    column[used] = np.arange(len(used), dtype=np.int32)
    landmarks = np.zeros((len(marks), len(used)), np.float32)
    for r, k in enumerate(marks):
        landmarks[r, column[cells[k]]] = 1 / np.sqrt(max(len(cells[k]), 1))
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    good = values > 1e-8 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    gram, target = 0.0, 0.0
    mapped = []
    for at in range(0, len(cells), BATCH):
        some = cells[at : at + BATCH]
        seen = np.zeros((len(some), len(used)), np.float32)
        for r, c in enumerate(some):
            rows = column[c]
            seen[r, rows[rows >= 0]] = 1 / np.sqrt(max(len(c), 1))
        phi = (seen @ landmarks.T).astype(np.float64) @ root
        mapped.append(np.hstack([phi, np.ones((len(some), 1))]))
    for at, phi in zip(range(0, len(cells), BATCH), mapped):
        y = np.array([[1.0 if name == c else -1.0 for c in classes] for name in languages[at : at + BATCH]])
        gram, target = gram + phi.T @ phi, target + phi.T @ y
    ridge = RIDGE * len(cells) * np.eye(len(gram))
    ridge[-1, -1] = 1e-9
    solved = np.linalg.solve(gram + ridge, target)
    weights = landmarks.T.astype(np.float64) @ (root @ solved[:-1])
    return Model(classes, column, weights.astype(np.float32), solved[-1])


def pack_cells(cells: np.ndarray) -> bytes:
    """Present cells as their numbers, or as one bit each where that is no longer."""
    if 4 * len(cells) < FEATURES // 8:
        return cells.astype("<i4").tobytes()
    bits = np.zeros(FEATURES, np.uint8)
    bits[cells] = 1
    return np.packbits(bits).tobytes()


def unpack_cells(packed: bytes) -> np.ndarray:
    if len(packed) < FEATURES // 8:
        return np.frombuffer(packed, "<i4")
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8))).astype("<i4")


def fit(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    usable: Column | None = None,
    fit_rows: int = FIT_ROWS,
) -> Model | None:
    """Learn from rows with a language (and `usable`, a condition on doc_id), at most fit_rows in all and
    equally many of each language, chosen by a hash of the id. None if there are no such rows.

    Of the rows that share an id and a language, the text that sorts first is used. With more than fit_rows
    languages, the most frequent ones are learned. The driver gets at most fit_rows rows of FEATURES / 8 bytes."""
    known = picked(docs, doc_id=doc_id, lang=lang).filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    if usable is not None:
        known = known.filter(usable)
    # ids of each language, of at most fit_rows languages
    sizes = materialize(known.distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(fit_rows), "languages")
    classes = sizes.count()
    if not classes:
        return None
    # a frequent language is thinned by a hash to a few times what is wanted, where it is read
    wanted = max(1, fit_rows // classes)
    thinned = known.join(F.broadcast(sizes), "lang").filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.col("n")) < 4 * wanted)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = thinned.select("doc_id", "lang").distinct().withColumn("place", place).filter(F.col("place") <= wanted)
    chosen = materialize(chosen.select("doc_id", "lang"), "language-sample")
    # at most fit_rows ids
    texts = picked(docs, doc_id=doc_id, text=text, lang=lang).filter(F.col("text").isNotNull())
    sample = texts.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scratch = np.zeros(FEATURES, np.uint8)
        for batch in batches:
            cells = [pack_cells(present(t, scratch)) for t in strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, pa.binary())], ["lang", "cells"])

    features = sample.select("lang", "text").mapInArrow(run, "lang string, cells binary")
    rows = features.orderBy("lang", F.xxhash64("cells")).collect()  # fit_rows rows of FEATURES / 8 bytes at most
    if not rows:
        return None
    return _solve([r["lang"] for r in rows], [unpack_cells(bytes(r["cells"])) for r in rows])


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, lang_pred, score (0 to 1).

    A null text, or one without a letter, is `und` with score 0, and so is every text without a model.
    Map-only; the model has FEATURES cells and at most one weight per landmark n-gram and language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dict(vars(model)) if model else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**shared.value) if shared.value else None
        for batch in batches:
            texts = strings(batch.column(1))
            names, scores = known.score(texts) if known else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    kind = field_type(docs, doc_id)
    return picked(docs, doc_id=doc_id, text=text).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
