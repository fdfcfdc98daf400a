"""Small frames with the awkward rows every operator must take."""

LONG = " ".join(f"word{k % 977} {k}" for k in range(60_000))

AWKWARD = [
    (1, "Plain words, once.", "en"),
    (2, None, None),
    (3, "", "en"),
    (4, " \t\n ", "xx"),
    (5, LONG, "en"),
    (6, "Plain words, once.", "en"),
    (6, "Plain words, once.", "en"),
    (None, "no id at all", None),
    (7, "…ünï — ß́ 漢字 \U0001f600", "de"),
    (8, "a", None),
]


def awkward(spark, **extra):
    """doc_id, text, lang and more constant columns."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(AWKWARD, "doc_id bigint, text string, lang string")
    return df.withColumns({name: F.lit(value) for name, value in extra.items()})


def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string")


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
