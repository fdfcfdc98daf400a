import zlib

import numpy as np
from helpers import AWKWARD, awkward, empty, got
from pyspark.sql import functions as F

from cartlens.llm import langid


def grams(text):
    t = text.lower()
    return {t[k : k + n] for n in range(1, langid.ORDERS + 1) for k in range(len(t) - n + 1)}


def test_present_is_a_set_of_ngrams(monkeypatch):
    table = np.zeros(langid.FEATURES, np.uint8)
    text = "Ein Satz mit Wörtern, und noch einer. 漢字" * 3
    cells = langid.present(text, table)
    assert not table.any() and abs(len(cells) - len(grams(text))) <= 2  # hashing may join two
    monkeypatch.setattr(langid, "SPAN", 10)
    assert (langid.present(text, table) == cells).all()
    assert len(langid.present("", table)) == 0


def test_scores_are_the_kernel_machine():
    """Folded weights give the same values as kernels with the landmarks."""
    texts = [f"the thing and {k} other things were" for k in range(30)] + [f"und das war der {k} andere" for k in range(30)]
    names = ["en"] * 30 + ["de"] * 30
    table = np.zeros(langid.FEATURES, np.uint8)
    model = langid._solve(names, [langid.present(t, table) for t in texts])
    assert model.languages == ["de", "en"]
    assert model.score(["the other thing", "das andere"])[0] == ["en", "de"]
    # explicit kernels with the landmarks (here all texts), a Nyström map of them, and ridge regression on it
    def kernel(a, b):
        return len(a & b) / np.sqrt(max(len(a), 1) * max(len(b), 1))

    sets = [set(langid.present(t, table).tolist()) for t in texts]
    gram = np.array([[kernel(a, b) for b in sets] for a in sets])
    values, vectors = np.linalg.eigh(gram)
    good = values > 1e-8 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    design = np.hstack([gram @ root, np.ones((len(sets), 1))])
    y = np.array([[1.0 if name == c else -1.0 for c in model.languages] for name in names])
    ridge = langid.RIDGE * len(sets) * np.eye(design.shape[1])
    ridge[-1, -1] = 1e-9
    solved = np.linalg.solve(design.T @ design + ridge, design.T @ y)
    for text in ["the other thing", "das andere", "und the war", "zzz"]:
        mine = set(langid.present(text, table).tolist())
        expected = np.array([kernel(mine, b) for b in sets]) @ root @ solved[:-1] + solved[-1]
        cells = np.array(sorted(mine))
        seen = [model.column[c] for c in cells if model.column[c] >= 0]
        folded = model.weights[seen].sum(axis=0) / np.sqrt(len(cells)) + model.bias
        assert np.allclose(folded, expected, atol=2e-3)
    assert model.score(["123 !", ""]) == (["und", "und"], [0.0, 0.0])


def test_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = langid.fit(docs, usable=fold != 1)
    rows = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(held) > 30 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_fit_is_bounded(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert langid.fit(docs, fit_rows=20).languages == ["de", "en", "es", "fr"]


def test_packed_cells():
    for n in (0, 1, 8191, 8192, 20_000):
        cells = np.sort(np.random.default_rng(n).choice(langid.FEATURES, n, replace=False)).astype("<i4")
        packed = langid.pack_cells(cells)
        assert len(packed) <= langid.FEATURES // 8 and (langid.unpack_cells(packed) == cells).all()


def test_repeated_ids_do_not_widen_the_sample(spark, monkeypatch):
    rows = [(k % 4, f"{'the cat' if k % 2 else 'der hund'} {k}", "en" if k % 2 else "de") for k in range(400)]
    sizes = []
    solve = langid._solve
    monkeypatch.setattr(langid, "_solve", lambda names, cells: sizes.append(len(names)) or solve(names, cells))
    langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), fit_rows=4)
    langid.fit(spark.createDataFrame([(k, "some text", f"l{k}") for k in range(50)], "doc_id bigint, text string, lang string"), fit_rows=10)
    assert sizes == [4, 10]


def test_awkward_rows(spark):
    train = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate([("the cat", "en"), ("der hund", "de")] * 5)], "doc_id bigint, text string, lang string")
    model = langid.fit(train)
    rows = dict((r[0], r[1:]) for r in got(langid.predict(awkward(spark, score="x", cells=1), model), "doc_id", "lang_pred", "score"))
    assert len(rows) == len({d for d, _, _ in AWKWARD})
    assert rows[2] == rows[3] == rows[4] == ("und", 0.0) and rows[1][0] in ("de", "en")
    assert langid.predict(empty(spark), model).count() == 0
    assert langid.fit(empty(spark)) is None
    assert got(langid.predict(awkward(spark), None), "lang_pred") == [("und",)] * len(AWKWARD)
