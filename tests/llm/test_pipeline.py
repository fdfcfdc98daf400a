"""Registered queries, and the pipeline stage by stage against brute force."""

import os

import pytest
from check import compare, duck
from helpers import got
from test_decontaminate import brute as contaminated
from test_exact_dedup import brute as exact
from test_simhash import groups_of, plain_print

from cartlens.llm import packing, queries
from cartlens.llm.tokens import Encoder, vocabulary_path


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, folder, name):
    assert compare(queries.queries()[name](spark, folder), duck(folder).execute(queries.oracle_sql()[name]).df()) == ""


def test_all_operators_are_registered():
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names and set(queries.oracle_sql()) <= set(names)


def test_simhash_query_equals_brute_force(spark, folder):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    prints = {d: plain_print(t) for d, t in docs.items()}
    expected = sorted((d, f"{prints[d]:016x}", c) for d, c in groups_of(prints, 4).items())
    assert sorted(got(queries.op7_simhash(spark, folder), "doc_id", "fingerprint", "component_id")) == expected


def test_toxicity_query(spark, folder):
    rows = queries.op8_toxicity(spark, folder)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    assert rows.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_pipeline_equals_brute_force(spark, folder):
    import corpus_pipeline

    folder = folder.replace("sf0.001", "sf0.01")  # the smallest tables have too few toxic labels to learn from
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(os.path.join(folder, "documents.parquet"))
    model = queries.toxicity_model(spark, docs, folder)
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if model.score(r["text"] or "")[0] < 0.5}
    assert len(texts) < docs.count()
    texts = {d: texts[d] for d, _, _, kept, _ in exact(list(texts.items())) if kept}
    groups = groups_of({d: plain_print(t) for d, t in texts.items()}, 4)
    texts = {d: t for d, t in texts.items() if groups[d] == d}
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in contaminated(list(texts.items()), items) if r[5]}
    encoder = Encoder(vocabulary_path())
    expected = []
    for d, t in texts.items():
        if d not in bad:
            n, at = len(encoder._whole(t)) // 4 + 1, 0
            for size in packing.piece_lengths(n, 2048):
                expected.append((d, at, size, n))
                at += size
    assert got(corpus_pipeline.run(spark, folder), "doc_id", "start", "length", "doc_tokens") == sorted(expected, key=repr)
