"""Customer features at customer grain and at joined-row grain.

Row-grain figures weigh a customer by its joined rows. They are computed from counted
combinations (n_rows per distinct combination) instead of from the repeated rows, so that a
customer with a third of all rows contributes a few thousand counted combinations.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.functions import dates, labels
from cartlens.operators.aggregates import exact, money_sum, row_count, row_mean, row_sum
from cartlens.operators.keyjoin import attach_per_key
from cartlens.plans.wide import join_wide
from cartlens.session import materialize

PERSON = "customer_unique_id"
FEATURES = ("monetary_value", "frequency", "customer_tenure", "late_deliveries", "num_orders")
PRODUCT_SIZES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
CORRELATED = ("review_score", "recency", "frequency", "monetary_value", "customer_tenure", "late_deliveries", "num_orders")


def late_column():
    return labels.late_flag(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))


def order_facts(wide: DataFrame) -> DataFrame:
    """Joined rows counted per order, lateness and review score."""
    return (
        wide.withColumn("late_deliveries", late_column())
        .groupBy(PERSON, "customer_id", "order_id", "order_purchase_timestamp", "late_deliveries", "review_score")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(exact("payment_value")).alias("paid"),
        )
    )


class CustomerFacts:
    """The wide table reduced once to order facts, and the frames derived from them.

    facts, if given, are the order facts made without the wide join (plans.factored.order_facts); then
    only figures that need every joined row run that join, once. tables, if given, are those that wide joins."""

    def __init__(self, wide: DataFrame, facts: DataFrame | None = None, tables: Mapping[str, DataFrame] | None = None):
        self.wide = wide
        self.tables = tables
        self.facts = order_facts(wide) if facts is None else facts

    @cached_property
    def orders(self) -> DataFrame:
        return materialize(self.facts, "order-facts")

    @property
    def latest(self):
        """The last purchase of the whole table, as a scalar subquery."""
        return self.orders.agg(F.max("order_purchase_timestamp")).scalar()

    @property
    def typical_score(self):
        """The mean review score of all rows, cut to an integer, an unknown score being 0."""
        total = F.sum(F.coalesce(F.col("review_score"), F.lit(0)) * F.col("n_rows"))
        return self.orders.agg((total / F.sum("n_rows")).cast("int")).scalar()

    @cached_property
    def customers(self) -> DataFrame:
        """recency, frequency, monetary_value, customer_tenure, late_deliveries, num_orders
        per person; recency counts from the person's last purchase."""
        grouped = self.orders.groupBy(PERSON).agg(
            F.sum("n_rows").alias("frequency"),
            F.sum(F.col("paid").cast("decimal(28,10)")).cast("double").alias("monetary_value"),
            F.min("order_purchase_timestamp").alias("first_purchase"),
            F.max("order_purchase_timestamp").alias("last_purchase"),
            F.sum(F.col("late_deliveries") * F.col("n_rows")).alias("late_deliveries"),
            F.count_distinct("order_id").alias("num_orders"),
        )
        frame = grouped.select(
            PERSON,
            dates.whole_days(self.latest, F.col("last_purchase")).alias("recency"),
            "frequency",
            "monetary_value",
            dates.whole_days(F.col("last_purchase"), F.col("first_purchase")).alias("customer_tenure"),
            "late_deliveries",
            "num_orders",
            "first_purchase",
            "last_purchase",
        )
        return materialize(frame, "customers")

    @cached_property
    def counted_rows(self) -> DataFrame:
        """Row grain, counted: one row per person, recency, lateness and score with n_rows.

        A person has at most one entry per day, flag and score, so the join with the
        per-person features is not skewed however many rows the person has.
        """
        recency = dates.whole_days(self.latest, F.col("order_purchase_timestamp")).alias("recency")
        counted = self.orders.groupBy(PERSON, recency, "late_deliveries", "review_score").agg(
            F.sum("n_rows").alias("n_rows")
        )
        per_person = self.customers.select(PERSON, "frequency", "monetary_value", "customer_tenure", "num_orders")
        return materialize(counted.join(per_person, PERSON), "counted-rows")

    def rows(self, wide: DataFrame | None = None) -> DataFrame:
        """Every joined row with its person's features next to it."""
        wide = self.wide if wide is None else wide
        recency = dates.whole_days(self.latest, F.col("order_purchase_timestamp"))
        rows = wide.withColumns({"recency": recency, "late_deliveries": late_column()})
        per_person = self.customers.select(PERSON, "frequency", "monetary_value", "customer_tenure", "num_orders")
        return attach_per_key(rows, per_person, PERSON, "frequency", ["order_id", "product_id", "seller_id"])

    def rows_with(self, columns: Sequence[str]) -> DataFrame:
        """Every joined row with the given columns of its person. They meet the orders, before rows multiply,
        so that the rows themselves are not moved for them."""
        per_person = self.customers.select(PERSON, *dict.fromkeys(["frequency", "num_orders", *columns]))
        if self.tables is None:
            return attach_per_key(self.wide, per_person, PERSON, "frequency", ["price", "freight_value"])
        placed = self.tables["orders"].join(self.tables["customers"], "customer_id")
        heads = attach_per_key(placed, per_person, PERSON, "num_orders", ["order_id"])
        return join_wide({**self.tables, "order_heads": heads})


def late_per_customer(facts: CustomerFacts) -> DataFrame:
    """Late joined rows per customer_id."""
    return facts.orders.groupBy("customer_id").agg(
        F.sum(F.col("late_deliveries") * F.col("n_rows")).alias("total_late_deliveries")
    )


def customer_rollup(rows: DataFrame, bought: DataFrame | None = None) -> DataFrame:
    """One row per person with mixed aggregates over its joined rows (intervals included), plain or counted.
    Counted rows are of order grain; then bought has the persons' product_ids.

    num_orders counts the distinct values of a per-person constant, and monetary_value adds
    the person's total once per row; both are kept as published. The corrected figures are
    in CustomerFacts.customers. The largest recency of a person belongs to its first purchase,
    so the last purchase of all is needed only after grouping, from one row per person.
    """
    paid, n = F.sum(exact("payment_value")), row_count(rows)
    products = [] if bought is not None else [F.count_distinct("product_id").alias("product_id")]
    first, last = F.min("order_purchase_timestamp"), F.max("order_purchase_timestamp")
    grouped = rows.groupBy(PERSON).agg(
        F.max("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        F.max("customer_city").alias("customer_city"),
        F.max("customer_state").alias("customer_state"),
        F.count_distinct("order_id").alias("order_id"),
        row_mean(rows, "purchased_approved").alias("purchased_approved"),
        F.min("delivered_estimated").alias("delivered_estimated"),
        row_mean(rows, "purchased_delivered").alias("purchased_delivered"),
        *products,
        money_sum("price").alias("price"),
        money_sum("freight_value").alias("freight_value"),
        F.max("payment_type").alias("payment_type"),
        F.max("payment_installments").alias("payment_installments"),
        paid.cast("double").alias("payment_value"),
        row_mean(rows, "review_score").alias("review_score"),
        F.lit(1).cast("bigint").alias("num_orders"),
        n.cast("double").alias("frequency"),
        (paid * n.cast("decimal(16,0)")).cast("double").alias("monetary_value"),
        dates.whole_days(last, first).alias("customer_tenure"),
        row_sum(rows, late_column()).alias("late_deliveries"),
        first.alias("__first"),
        last.alias("__last"),
    )
    if bought is not None:
        # a person's equal products meet before the shuffle; null is a person of its own here too
        numbers = bought.select(PERSON, "product_id").distinct().groupBy(PERSON).agg(F.count("product_id").alias("product_id"))
        grouped = grouped.alias("g").join(numbers.alias("p"), F.col(f"g.{PERSON}").eqNullSafe(F.col(f"p.{PERSON}"))).drop(numbers[PERSON])
    people = materialize(grouped, "rollup")
    latest = people.agg(F.max("__last")).scalar()
    return people.withColumn("recency", dates.whole_days(latest, F.col("__first"))).drop("__first", "__last")


def product_behaviour(rows: DataFrame, k: int | None = 10) -> DataFrame:
    """Orders, revenue, freight, mean size and mean score per product, most ordered first."""
    per_product = rows.groupBy("product_id").agg(
        F.count_distinct("order_id").alias("orders"),
        money_sum("price").alias("price"),
        money_sum("freight_value").alias("freight_value"),
        *[row_mean(rows, c).alias(c) for c in (*PRODUCT_SIZES, "review_score")],
    )
    return per_product if k is None else per_product.orderBy(F.desc("orders"), "product_id").limit(k)
