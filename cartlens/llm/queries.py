"""The registered queries of this subpackage: thin, with production settings, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.llm import (
    alignment, binary_ids, byte_bpe, decontaminate, exact_dedup, html_text, langid, licenses, packing, pii, simhash, spectrum,
    toxicity,
)
from cartlens.llm.common import prepare
from cartlens.llm.tokens import vocabulary_path
from cartlens.session import scratch_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def _remainder(divisor: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo divisor; a null id belongs to no fold."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % divisor


# A real run gives its own secret; this one only makes the registered query repeatable.
SURROGATE_KEY = "registered-query"


def op1_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    replaced = pii.replace(_table(spark, folder, "documents"), SURROGATE_KEY)
    return replaced.select("doc_id", "text", "n_entities", "kinds")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.piece_digests(packing.decompose(_table(spark, folder, "documents"), vocabulary_path()))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_bit_planes(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(prepare(spark), "ids")
    binary_ids.write_ids(_table(spark, folder, "documents"), path, vocabulary_path())
    return binary_ids.document_digests(binary_ids.read_ids(spark, path))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = langid.fit(docs, usable=_remainder(3) != 1)
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, folder, "documents"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def toxicity_model(spark: SparkSession, docs: DataFrame, folder: str) -> toxicity.Model:
    return toxicity.fit(docs, _table(spark, folder, "labels"), usable=_remainder(5) != 0)


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity_model(spark, docs, folder))
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_table(spark, folder, "documents"))


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(_table(spark, folder, "pages"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    whitened = spectrum.whiten(_table(spark, folder, "embeddings"))
    return whitened.select(
        "vec_id", "component", "n", F.col("deviation").cast("bigint").alias("deviation"), "whitened", "explained", "identity_error"
    )


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_documents(
        _table(spark, folder, "documents"), vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
    )


def op13_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = vocabulary_path("byte_bpe_multi_50k.tiktoken")
    back = byte_bpe.decode(byte_bpe.encode(_table(spark, folder, "documents"), ranks), ranks)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


DECONTAMINATION_SQL = """
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), grams AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[k:k + least(len(w), 13) - 1], ' ') AS gram
  FROM item_words, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS r(k) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM grams
), hits AS (
  SELECT doc_id, k, p.n, array_to_string(w[k:k + p.n - 1], ' ') AS gram
  FROM lowered, sizes p, unnest(range(1, len(w) - p.n + 2)) AS r(k) WHERE len(w) >= p.n
), found AS (
  SELECT h.doc_id, h.k, h.n, g.item_id FROM hits h JOIN grams g ON g.n = h.n AND g.gram = h.gram
), covered AS (
  SELECT doc_id, count(DISTINCT k + o) AS n_hit FROM found, unnest(range(0, n)) AS r(o) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id
)
SELECT l.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM lowered l LEFT JOIN covered c ON c.doc_id = l.doc_id LEFT JOIN items i ON i.doc_id = l.doc_id
"""

EXACT_SQL = """
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM hashed WINDOW w AS (PARTITION BY text_sha256)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_bit_planes": op4_bit_planes,
    "op5_language": op5_language,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_simhash": op7_simhash,
    "op8_toxicity": op8_toxicity,
    "op9_licenses": op9_licenses,
    "op10_main_text": op10_main_text,
    "op11_whitening": op11_whitening,
    "op12_alignment": op12_alignment,
    "op13_prefix_bpe": op13_prefix_bpe,
    "pipeline": pipeline,
}

ORACLES = {"op3_decontamination": DECONTAMINATION_SQL, "op6_exact_dedup": EXACT_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
