"""Recency, frequency and monetary scores and the segments built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.functions import buckets, labels
from cartlens.operators import quantiles, weighted
from cartlens.operators.aggregates import counts
from cartlens.plans.features import FEATURES, CustomerFacts

SCORED = {"recency": "recency_score", "frequency": "frequency_score", "monetary_value": "monetary_score"}
SCORES = ("recency_score", "frequency_score", "monetary_score")


def rfm_base(facts: CustomerFacts, grain: str = "row") -> DataFrame:
    """Values to score with n_rows: every joined row, or every person once."""
    if grain == "customer":
        return facts.customers.select(
            "customer_unique_id", "recency", "frequency", "monetary_value", F.lit(1).cast("bigint").alias("n_rows")
        )
    return facts.counted_rows.groupBy("customer_unique_id", "recency", "frequency", "monetary_value").agg(
        F.sum("n_rows").alias("n_rows")
    )


def add_scores(df: DataFrame, edges: dict[str, Sequence[float]], invert_recency: bool = False) -> DataFrame:
    """Quartile scores and their sum. The edges are literals, so scoring is a projection."""
    scores = {out: buckets.bin_index(F.col(c), edges[c]) for c, out in SCORED.items()}
    if invert_recency:
        top = max(len(set(edges["recency"])) - 2, 0)
        scores["recency_score"] = F.lit(top) - scores["recency_score"]
    df = df.withColumns(scores)
    return df.withColumn("rfm_score", F.col(SCORES[0]) + F.col(SCORES[1]) + F.col(SCORES[2]))


def add_segment(df: DataFrame, include_lowest: bool = False) -> DataFrame:
    """Inactive, Regular, Engaged; score 0 has no segment unless include_lowest."""
    return df.withColumn(
        "segment",
        buckets.cut(F.col("rfm_score"), buckets.RFM_EDGES, buckets.RFM_LABELS, include_lowest=include_lowest),
    )


def rfm_scores(facts: CustomerFacts, grain: str = "row", invert_recency: bool = False, include_lowest: bool = False) -> DataFrame:
    base = rfm_base(facts, grain)
    edges = quantiles.quartile_edges(base, list(SCORED), "n_rows")
    return add_segment(add_scores(base, edges, invert_recency), include_lowest)


def segment_counts(scored: DataFrame) -> DataFrame:
    """Rows per segment; unsegmented rows are not listed."""
    return scored.filter(F.col("segment").isNotNull()).groupBy("segment").agg(F.sum("n_rows").alias("n"))


def score_segment_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("rfm_score", "segment").agg(F.sum("n_rows").alias("n"))


def recency_segments(rows: DataFrame) -> DataFrame:
    segment = buckets.cut(F.col("recency"), buckets.RECENCY_EDGES, buckets.RECENCY_LABELS, right=False)
    return rows.withColumn("recency_segment", segment)


def monetary_segments(rows: DataFrame, weight: str = "n_rows") -> DataFrame:
    """Segments of the values inside the IQR fence; outliers and large values get none."""
    limits = quantiles.iqr_limits(rows, ["monetary_value"], weight)["monetary_value"]
    kept = F.when(quantiles.inside("monetary_value", limits), F.col("monetary_value"))
    return rows.withColumn("monetary_segment", buckets.cut(kept, buckets.MONETARY_EDGES, buckets.MONETARY_LABELS))


def late_segments(late: DataFrame) -> DataFrame:
    segment = buckets.cut(F.col("total_late_deliveries"), buckets.LATE_EDGES, buckets.LATE_LABELS)
    return late.withColumn("late_delivery_segment", segment)


def late_segment_counts(late: DataFrame) -> DataFrame:
    return counts(late_segments(late), "late_delivery_segment")


def churn_rows(facts: CustomerFacts, days: int = labels.CHURN_DAYS) -> DataFrame:
    """Counted rows with the churn label as text."""
    return facts.counted_rows.withColumn("churn", labels.churn_flag(F.col("recency"), days).cast("string"))


def churn_profile(facts: CustomerFacts, standardised: bool = False, days: int = labels.CHURN_DAYS) -> DataFrame:
    """Feature means of churned and kept rows, plain or after standardising."""
    rows = churn_rows(facts, days)
    if standardised:
        return weighted.standardised_means(rows, "churn", FEATURES)
    return weighted.weighted_means(rows, ["churn"], FEATURES)


def historical_clv(facts: CustomerFacts, weighting: str = "row") -> DataFrame:
    """Mean monetary value, mean frequency, mean tenure and their product."""
    rows = facts.counted_rows if weighting == "row" else facts.customers.withColumn("n_rows", F.lit(1))
    means = rows.agg(
        weighted.wmean("monetary_value", "n_rows").alias("average_purchase_value"),
        weighted.wmean("frequency", "n_rows").alias("purchase_frequency"),
        weighted.wmean("customer_tenure", "n_rows").alias("average_customer_lifespan"),
    )
    product = F.col("average_purchase_value") * F.col("purchase_frequency") * F.col("average_customer_lifespan")
    return means.withColumn("historical_clv", F.round(product, 2))


def log_features(rows: DataFrame, passes: int = 2) -> DataFrame:
    """log1p of the skewed columns, recency shifted by one first; applied twice as published."""
    return rows.withColumns({
        "recency": buckets.log_shifted(F.col("recency"), 1.0, passes),
        "frequency": buckets.log_shifted(F.col("frequency"), 0.0, passes),
        "monetary_value": buckets.log_shifted(F.col("monetary_value"), 0.0, passes),
    })
