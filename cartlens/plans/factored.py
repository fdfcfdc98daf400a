"""Figures over the rows of the wide join, without making those rows.

Items, payments and reviews of an order multiply in the wide join. A figure that groups by columns of
one or two of these tables, and counts or adds up, needs none of the products: every table is first
reduced to one row per order and wanted key with its number of rows and its totals, and only these meet.
A joined row then stands for joined_rows rows of the wide join, and a total is already multiplied
by the rows of the other tables. Reduction happens in the tasks before the shuffle, so an order
with very many rows arrives as a few.

The figures in plans.kpis take such counted rows as well as plain ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.operators.aggregates import JOINED_ROWS, exact, known
from cartlens.plans import wide
from cartlens.plans.features import PERSON, PRODUCT_SIZES, customer_rollup, late_column, product_behaviour

# The multiplying tables, by the names used for their wanted columns.
PARTS = {"items": "order_items", "payments": "order_payments", "reviews": "order_reviews"}
# Digits of a total before it is multiplied, and of what multiplies it: together the widest exact decimal.
TOTAL, FACTOR = "decimal(25,10)", "decimal(12,0)"


def part_rows(t: Mapping[str, DataFrame], part: str) -> DataFrame:
    """Rows of one multiplying table as the wide join has them; items with their product and seller."""
    rows = t[PARTS[part]]
    if part != "items":
        return rows
    categorised = t["products"].join(t["category_translation"], "product_category_name")
    return rows.join(categorised, "product_id").join(t["sellers"], "seller_id")


def counted_rows(
    t: Mapping[str, DataFrame],
    order: Sequence[str] = (),
    items: Sequence[str] = (),
    payments: Sequence[str] = (),
    reviews: Sequence[str] = (),
    totals: Sequence[str] = (),
    largest: Sequence[str] = (),
) -> DataFrame:
    """order_id, the wanted columns of orders and customers, the keys of each part, joined_rows, for each of
    `totals` its sum over the joined rows (exact decimal) and known(total), the joined rows that have it, and for
    each of `largest` the largest value within the order and keys.

    t holds cleaned tables (wide.cleaned_tables) or raw ones; filters and derived columns of orders or
    reviews are put on t["orders"] and t["order_reviews"] before. A null key is a key of its own.
    """
    keys = {"items": list(items), "payments": list(payments), "reviews": list(reviews)}
    joined = t["orders"].join(t["customers"], "customer_id").select("order_id", *order)
    owner: dict[str, str] = {}
    for part, by in keys.items():
        rows = part_rows(t, part)
        sums = []
        for c in totals:
            if c in rows.columns:
                owner[c] = part
                sums += [F.sum(exact(c)).cast(TOTAL).alias(c), F.count(c).alias(known(c))]
        sums += [F.max(c).alias(c) for c in largest if c in rows.columns]
        reduced = rows.groupBy("order_id", *by).agg(F.count(F.lit(1)).alias(f"__{part}"), *sums)
        joined = joined.join(reduced, "order_id")
    missing = [c for c in totals if c not in owner]
    if missing:
        raise ValueError(f"no multiplying table has the columns {missing}")
    n = {part: F.col(f"__{part}") for part in keys}
    multiplied = []
    for c, part in owner.items():
        others = F.lit(1).cast("bigint")
        for other, count in n.items():
            others = others * count if other != part else others
        multiplied += [(F.col(c) * others.cast(FACTOR)).alias(c), (F.col(known(c)) * others).alias(known(c))]
    every = [*order, *(k for by in keys.values() for k in by)]
    return joined.select(
        "order_id", *every, (n["items"] * n["payments"] * n["reviews"]).alias(JOINED_ROWS), *multiplied, *largest
    )


def dashboard_tables(t: Mapping[str, DataFrame], cutoff: str) -> dict[str, DataFrame]:
    """Cleaned tables whose orders and reviews are those of wide.dashboard_view, with its columns."""
    cleaned = wide.cleaned_tables(t, drop=False)
    orders = wide.dashboard_orders(cleaned["orders"], cutoff)
    return cleaned | {"orders": orders, "order_reviews": wide.with_answer_times(cleaned["order_reviews"])}


def order_facts(t: Mapping[str, DataFrame]) -> DataFrame:
    """features.order_facts of the wide join of these tables."""
    rows = counted_rows(
        t | {"orders": t["orders"].withColumn("late_deliveries", late_column())},
        order=[PERSON, "customer_id", "order_purchase_timestamp", "late_deliveries"],
        reviews=["review_score"],
        totals=["payment_value"],
    )
    return rows.groupBy(PERSON, "customer_id", "order_id", "order_purchase_timestamp", "late_deliveries", "review_score").agg(
        F.sum(JOINED_ROWS).alias("n_rows"), F.sum(exact("payment_value")).alias("paid")
    )




def rollup(t: Mapping[str, DataFrame]) -> DataFrame:
    """features.customer_rollup of the wide join of these tables."""
    timed = t | {"orders": wide.with_intervals(t["orders"])}
    rows = counted_rows(
        timed,
        order=[
            PERSON, "customer_zip_code_prefix", "customer_city", "customer_state", "purchased_approved", "delivered_estimated",
            "purchased_delivered", "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date",
        ],
        totals=["price", "freight_value", "payment_value", "review_score"],
        largest=["payment_type", "payment_installments"],
    )
    return customer_rollup(rows, counted_rows(t, order=[PERSON], items=["product_id"]))


def behaviour(t: Mapping[str, DataFrame], k: int | None = 10) -> DataFrame:
    """features.product_behaviour of the wide join of these tables."""
    rows = counted_rows(t, items=["product_id", *PRODUCT_SIZES], totals=["price", "freight_value", "review_score"])
    return product_behaviour(rows, k)
