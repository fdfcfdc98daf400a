"""Classifier evaluation from a frame with label and prediction or score columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.operators.ordered import running_totals


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """actual, predicted, n for all four cells of a binary classifier."""
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    aggs = [F.count_if((F.col(label) == a) & (F.col(prediction) == p)).alias(f"__{a}{p}") for a, p in cells]
    entries = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"__{a}{p}").alias("n")) for a, p in cells
    ]
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """class, precision, recall, f1, support for 0, 1, accuracy, macro and weighted averages.
    Undefined ratios are 0; the accuracy row repeats the accuracy in every ratio column."""
    y, p = F.col(label), F.col(prediction)
    one = df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    one = one.withColumns({
        "p0": ratio(tn, tn + fn), "r0": ratio(tn, tn + fp), "s0": tn + fp,
        "p1": ratio(tp, tp + fp), "r1": ratio(tp, tp + fn), "s1": tp + fn,
        "acc": ratio(tp + tn, tp + tn + fp + fn), "total": tp + tn + fp + fn,
    })
    one = one.withColumns({
        f"f{k}": ratio(2 * F.col(f"p{k}") * F.col(f"r{k}"), F.col(f"p{k}") + F.col(f"r{k}")) for k in (0, 1)
    })

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.cast("bigint").alias("support"),
        )

    def macro(m):
        return (F.col(f"{m}0") + F.col(f"{m}1")) / 2

    def weighted(m):
        return ratio(F.col(f"{m}0") * F.col("s0") + F.col(f"{m}1") * F.col("s1"), F.col("total"))

    acc, total = F.col("acc"), F.col("total")
    rows = [
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        row("accuracy", acc, acc, acc, total),
        row("macro avg", macro("p"), macro("r"), macro("f"), total),
        row("weighted avg", weighted("p"), weighted("r"), weighted("f"), total),
    ]
    return one.select(F.inline(F.array(*rows)))


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """threshold, fpr, tpr per distinct score, highest first, after the origin.

    Rows are counted per score, then accumulated over ranges of scores.
    """
    per_score = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    run = running_totals(per_score, [F.desc("threshold")], {"pos": "tp", "neg": "fp"})
    totals = run.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))).scalar()
    points = run.select(
        "threshold",
        F.try_divide(F.col("fp").cast("double"), totals["neg"]).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), totals["pos"]).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve by trapezoids. Between two distinct scores the curve rises in a
    straight line, so each score adds neg * (positives above + half of its own positives)."""
    per_score = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    run = running_totals(per_score, [F.desc("threshold")], {"pos": "tp"})
    area = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2.0))
    return run.agg(F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))
