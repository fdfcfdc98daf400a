import hashlib
import random
import re

import pytest
from helpers import AWKWARD, awkward, empty, got

from cartlens.llm import exact_dedup


def digest(text):
    return hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", text or "").encode()).hexdigest()


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(digest(t), []).append(d)
    out, done = [], set()
    for d, t in rows:
        h = digest(t)
        known = [x for x in groups[h] if x is not None]
        keep = min(known) if known else None
        kept = d == keep and (h not in done)
        if kept:
            done.add(h)
        out.append((d, keep, len(groups[h]), kept, h))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_awkward_rows(spark):
    df = awkward(spark, kept=1, digest="x", keep_id=5)
    assert got(exact_dedup.exact_groups(df), *COLUMNS) == brute([(d, t) for d, t, _ in AWKWARD])


@pytest.fixture(scope="module")
def many(spark):
    rng = random.Random(3)
    rows = [(k, f"text  {rng.randrange(9000)}" if k % 3 else "the hot text") for k in range(15_000)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)


@pytest.mark.parametrize("bits", [1 << 27, 1 << 17, 1 << 16])
def test_slices_and_full_filters(many, bits):
    rows, df = many
    assert got(exact_dedup.exact_groups(df, filter_bits=bits), *COLUMNS) == brute(rows)
    kept = got(exact_dedup.deduplicate(df, filter_bits=bits), "doc_id")
    assert kept == sorted(((r[0],) for r in brute(rows) if r[3]), key=repr)


def test_rows_that_occur_once_are_told(spark, many):
    rows, df = many
    hashed = df.select(exact_dedup.digest().alias("digest")).select("digest", *exact_dedup._hash_pair()).cache()
    marked = exact_dedup.mark_repeated(hashed)
    single = hashed.groupBy("digest").count().filter("count = 1")
    assert marked.filter("not repeated").join(single, "digest", "left_anti").count() == 0
    assert marked.filter("repeated").join(single, "digest").count() < 0.02 * len(rows)


def test_deduplicate_keeps_columns(spark):
    df = awkward(spark, h1="a", digest="b", again="c", found_id=1)
    kept = exact_dedup.deduplicate(df)
    assert kept.columns == df.columns
    # 2, 3 have the same empty text; 1 and both rows of 6 are equal
    ids = [r[0] for r in got(kept, "doc_id")]
    assert sorted(ids, key=repr) == sorted([1, 2, 4, 5, None, 7, 8], key=repr)


def test_empty(spark):
    assert exact_dedup.exact_groups(empty(spark)).count() == 0
    assert exact_dedup.deduplicate(empty(spark)).columns == ["doc_id", "text", "lang"]
    assert exact_dedup.deduplicate(empty(spark)).count() == 0
