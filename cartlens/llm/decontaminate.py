"""Benchmark decontamination with a broadcast hash set of test n-grams. DataFrame functions only.

Words are runs of ASCII letters and digits (A-Z in lower case) and of characters above 127. An item's
windows are its runs of WINDOW words, or the whole item if it is shorter. The windows' hashes are
broadcast, after a check of their number; every window of every document is hashed and looked up
while the words are scanned, and only windows whose words are really equal count as hits.

The scan expands a document's positions inside one generated stage and drops all but the hits and one
row per document before anything is shuffled; what is shuffled are those narrow rows, never texts.
More windows than one broadcast may hold are looked up in several scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import fresh, picked, whole_text
from cartlens.session import materialize

WINDOW = 13
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHARE = 20  # contaminated from 1/20 of the words on
BROADCAST_WINDOWS = 500_000


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, nothing else; lower() does that in texts without other letters."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def _window_hash(array: str, at: str, length: str) -> str:
    """Hash of a window's length and three of its words; equal windows have equal hashes."""
    last = f"{at} + {length} - 1"
    return f"xxhash64({length}, {array}[{at}], {array}[{at} + {length} div 2], {array}[{last}])"


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct windows of all items: hash, length, gram (words), items (ids). Items without words have none."""
    w = picked(items, item_id=item_id, text=text).select("item_id", words(whole_text()).alias("w")).filter("size(w) > 0")
    w = w.withColumn("n", F.least(F.size("w"), F.lit(window)))
    w = w.withColumn("at", F.explode(F.expr("sequence(0, size(w) - n)")))
    rows = w.selectExpr("item_id", "n", "slice(w, at + 1, n) as gram", f"{_window_hash('w', 'at', 'n')} as hash")
    return rows.groupBy("hash", F.col("n").alias("length"), "gram").agg(
        F.array_sort(F.collect_set("item_id")).alias("items")
    )


def _covered() -> Column:
    """Words under the union of hit windows, from the sorted array `hits` of (at, length)."""
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("bigint").alias("n"))

    def step(state: Column, hit: Column) -> Column:
        upto = hit["at"] + hit["length"]
        new = F.greatest(F.lit(0), upto - F.greatest(hit["at"], state["upto"]))
        return F.struct(F.greatest(state["upto"], upto).alias("upto"), (state["n"] + new).alias("n"))

    return F.aggregate("hits", start, step, lambda s: s["n"])


def _scan(base: DataFrame, grams: DataFrame, lengths: list[int], with_documents: bool) -> DataFrame:
    """Hits of the given windows, and one row without a hit (at -1) per document."""
    low = -1 if with_documents else 0
    scanned = base.withColumn("at", F.explode(F.sequence(F.lit(low), F.greatest(F.lit(low), F.col("n_words") - 1))))
    # one window of each length that items have, where the text is long enough
    found = [F.expr(f"if(at >= 0 and at + {n} <= n_words, {_window_hash('w', 'at', str(n))}, null)") for n in lengths]
    if len(lengths) == 1:
        scanned = scanned.withColumn("length", F.lit(lengths[0])).withColumn("hash", found[0])
    else:
        options = F.array(*[F.struct(F.lit(n).alias("length"), h.alias("hash")) for n, h in zip(lengths, found)])
        scanned = scanned.withColumn("option", F.explode(options)).select("*", "option.*").drop("option")
    table = F.broadcast(grams.select(F.col("hash").alias("g_hash"), F.col("length").alias("g_length"), "gram", "items"))
    same = (F.col("hash") == F.col("g_hash")) & (F.col("length") == F.col("g_length"))
    met = scanned.join(table, same, "left")
    hit = F.expr("gram is not null and slice(w, at + 1, length) = gram")
    document = (F.col("at") == -1) & (F.col("length") == F.lit(lengths[0]))
    rows = met.withColumn("is_hit", hit).withColumn("document", document).filter("is_hit or document")
    return rows.select(
        "doc_id", "text_hash", "n_words", "document",
        F.when(F.col("is_hit"), F.struct("at", "length")).alias("hit"), F.when(F.col("is_hit"), F.col("items")).alias("items"),
    )


def find(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """One row per input row: doc_id, text_hash, n_words, n_hit, n_items, item_ids (as strings, sorted),
    hits (first word and length of hit windows), items_sha256, contaminated.

    A null or empty text has no words and no hits. Rows that repeat id and text are reported each.
    A null item text has no windows; without items there are no hits; other columns are ignored.
    """
    grams = materialize(item_windows(items, item_id, item_text, window), "item-windows")
    passes = max(1, -(-grams.count() // broadcast_windows))
    lengths = sorted(r["length"] for r in grams.select("length").distinct().collect()) or [window]  # at most `window`
    base = picked(docs, doc_id=doc_id, text=text).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), words(whole_text()).alias("w")
    )
    base = base.withColumn("n_words", F.size("w"))
    rows = None
    for k in range(passes):
        part = grams.filter(F.pmod("hash", F.lit(passes)) == k) if passes > 1 else grams
        found = _scan(base, part, lengths, k == 0)
        rows = found if rows is None else rows.unionByName(found)
    per_doc = rows.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").cast("bigint").alias("n_words"),
        F.count_if("document").alias("copies"),
        F.array_sort(F.collect_set("hit")).alias("hits"),
        F.collect_set("items").alias("items"),
    )
    ids = F.array_sort(F.array_distinct(F.transform(F.flatten("items"), lambda i: i.cast("string"))))
    listed = per_doc.withColumn("n_hit", _covered()).withColumn("item_ids", ids)
    listed = listed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return listed.select(
        "doc_id", "text_hash", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), "item_ids", "hits",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs without the contaminated ones; all columns."""
    found = find(docs, items, doc_id, text, **options).filter("contaminated").select("doc_id", "text_hash").distinct()
    # written, so that its size is known: a short list is broadcast and texts are not moved
    found = materialize(found, "contaminated")
    a, b = fresh(docs, "found_id"), fresh(docs, "found_hash")
    found = found.select(F.col("doc_id").alias(a), F.col("text_hash").alias(b))
    return docs.join(found, docs[doc_id].eqNullSafe(F.col(a)) & (F.xxhash64(docs[text]) == F.col(b)), "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs with the words of hit windows, and what separates them from the word before, taken out of
    the text; other texts and all other columns stay as they are."""
    found = find(docs, items, doc_id, text, **options).filter("n_hit > 0").select("doc_id", "text_hash", "hits").distinct()
    found = materialize(found, "contaminated-spans")
    a, b, c = (fresh(docs, n) for n in ("found_id", "found_hash", "found_hits"))
    found = found.select(F.col("doc_id").alias(a), F.col("text_hash").alias(b), F.col("hits").alias(c))
    gap, word = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    pieces = F.regexp_extract_all(docs[text], F.lit(f"{gap}*{word}+"), F.lit(0))
    hits = F.col(c)
    outside = F.filter(
        pieces, lambda p, i: ~F.exists(hits, lambda h: (i >= h["at"]) & (i < h["at"] + h["length"]))
    )
    rest = F.concat(F.array_join(outside, ""), F.regexp_extract(docs[text], f"{gap}*$", 0))
    joined = docs.join(found, docs[doc_id].eqNullSafe(F.col(a)) & (F.xxhash64(docs[text]) == F.col(b)), "left")
    cleaned = F.when(hits.isNull(), docs[text]).otherwise(rest).alias(text)
    return joined.select(*[cleaned if n == text else docs[n] for n in docs.columns])
