"""Cleaning and the wide joined table."""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.functions import dates, labels
from cartlens.operators import clean
from cartlens.operators.keyjoin import HOT_SHARE, PART_ROWS, hot_keys, split_hot_join

ORDER_DROPS = ("order_delivered_carrier_date", "order_approved_at")
PRODUCT_DROPS = (
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)
REVIEW_REQUIRED = ("order_id", "review_id", "review_score", "review_creation_date", "review_answer_timestamp")
REVIEW_DROPS = ("review_comment_title", "review_comment_message")
SELLER_DROPS = ("seller_zip_code_prefix",)


def clean_orders(orders: DataFrame, drop: bool = True) -> DataFrame:
    """Delivered orders; a missing delivery date is taken from the estimate."""
    orders = clean.keep_status(orders)
    orders = clean.fill_from(orders, "order_delivered_customer_date", "order_estimated_delivery_date")
    return orders.drop(*ORDER_DROPS) if drop else orders


def clean_products(products: DataFrame, drop: bool = True) -> DataFrame:
    products = products.na.fill("unknown", subset=["product_category_name"])
    return products.drop(*PRODUCT_DROPS) if drop else products


def parse_reviews(reviews: DataFrame) -> DataFrame:
    """Review dates that arrive as text become timestamps, or null if they are none."""
    kinds = dict(reviews.dtypes)
    texts = [c for c in ("review_creation_date", "review_answer_timestamp") if kinds[c] == "string"]
    return reviews.withColumns({c: dates.parse_timestamp(F.col(c)) for c in texts}) if texts else reviews


def clean_reviews(reviews: DataFrame, drop: bool = True) -> DataFrame:
    """Reviews with all required columns."""
    reviews = clean.require(parse_reviews(reviews), REVIEW_REQUIRED)
    return reviews.drop(*REVIEW_DROPS) if drop else reviews


def clean_sellers(sellers: DataFrame, drop: bool = True) -> DataFrame:
    return sellers.drop(*SELLER_DROPS) if drop else sellers


ORDER_PARTS = ("order_payments", "order_reviews", "order_items")


TABLE_NAMES = (
    "orders", "customers", "order_items", "order_payments", "order_reviews", "products", "sellers", "category_translation",
)


def hot_orders(t: Mapping[str, DataFrame], hot_share: float = HOT_SHARE, part_rows: int = PART_ROWS) -> dict:
    """Orders that hold an outsized share of the payments, reviews or items, with the parts they take."""
    found: dict = {}
    for name in ORDER_PARTS:
        for key, parts in hot_keys(t[name], "order_id", hot_share, part_rows).items():
            found[key] = max(parts, found.get(key, 0))
    return found


def join_wide(t: Mapping[str, DataFrame], hot: Mapping = MappingProxyType({})) -> DataFrame:
    """Inner-join the eight tables; items, payments and reviews of an order multiply.

    The order-grain join with customers comes first, before rows multiply. Payments, reviews
    and items then share one hash partitioning on order_id. The category names join to the
    products, not to the rows. No side is hinted: Catalyst broadcasts what it measures to be
    small, and AQE splits hot products and sellers otherwise. AQE cannot split a join whose
    input is already partitioned, so hot orders, if there are any, are passed in and spread
    explicitly. order_heads, if given, are orders that have their customers already.
    """
    categorised = t["products"].join(t["category_translation"], "product_category_name")
    joined = t["order_heads"] if "order_heads" in t else t["orders"].join(t["customers"], "customer_id")
    for name in ORDER_PARTS:
        joined = split_hot_join(t[name], joined, "order_id", hot)
    return joined.join(categorised, "product_id").join(t["sellers"], "seller_id")


def cleaned_tables(t: Mapping[str, DataFrame], drop: bool = True) -> dict[str, DataFrame]:
    return {
        "orders": clean_orders(t["orders"], drop),
        "customers": t["customers"],
        "order_items": t["order_items"],
        "order_payments": t["order_payments"],
        "order_reviews": clean_reviews(t["order_reviews"], drop),
        "products": clean_products(t["products"], drop),
        "sellers": clean_sellers(t["sellers"], drop),
        "category_translation": t["category_translation"],
    }


def build_wide(t: Mapping[str, DataFrame], drop: bool = True, hot: Mapping = MappingProxyType({})) -> DataFrame:
    """The ETL result. drop=False keeps the columns the ETL discards."""
    return join_wide(cleaned_tables(t, drop), hot)


def raw_tables(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {**{name: t[name] for name in TABLE_NAMES}, "order_reviews": parse_reviews(t["order_reviews"])}


def raw_wide(t: Mapping[str, DataFrame]) -> DataFrame:
    """All tables joined without any cleaning, for exploration."""
    return join_wide(raw_tables(t))


def with_intervals(df: DataFrame) -> DataFrame:
    """Whole-day intervals between order events; positive delivered_estimated is on time."""

    def gap(later: str, earlier: str):
        return dates.whole_days(F.col(later), F.col(earlier))

    return df.withColumns({
        "purchased_approved": gap("order_approved_at", "order_purchase_timestamp"),
        "approved_carrier": gap("order_delivered_carrier_date", "order_approved_at"),
        "carrier_delivered": gap("order_delivered_customer_date", "order_delivered_carrier_date"),
        "delivered_estimated": gap("order_estimated_delivery_date", "order_delivered_customer_date"),
        "purchased_delivered": gap("order_delivered_customer_date", "order_purchase_timestamp"),
    })


def dashboard_orders(orders: DataFrame, cutoff: str = "2018-09") -> DataFrame:
    """Delivered orders (or rows with their columns) before the cutoff month, with the derived order columns."""
    df = clean.before_month(clean.keep_status(orders), "order_purchase_timestamp", cutoff)
    bought = F.col("order_purchase_timestamp")
    early = dates.whole_days(F.col("order_estimated_delivery_date"), F.col("order_delivered_customer_date"))
    return df.withColumns({
        "order_month_year": dates.month_label(bought),
        "weekday": dates.weekday_name(bought),
        "order_purchase_hour": F.hour(bought),
        "difference_purchased_delivered": dates.whole_days(F.col("order_delivered_customer_date"), bought),
        "estimated_delivered_difference": early,
        "delay_or_no_delay": labels.delay_label(early),
    })


def with_answer_times(reviews: DataFrame) -> DataFrame:
    answer = dates.whole_days(F.col("review_answer_timestamp"), F.col("review_creation_date"))
    return reviews.withColumns({
        "review_answer_time_difference": answer,
        "review_answer_time_difference_label": labels.answer_lag_label(answer),
    })


def with_review_times(rows: DataFrame) -> DataFrame:
    """Time from delivery to review; rows know both dates."""
    review = dates.whole_days(F.col("review_creation_date"), F.col("order_delivered_customer_date"))
    return rows.withColumns({
        "delivery_review_time_difference": review,
        "delivery_review_time_difference_label": labels.review_lag_label(review),
    })


def dashboard_view(wide: DataFrame, cutoff: str = "2018-09") -> DataFrame:
    """Delivered rows before the cutoff month with the derived dashboard columns."""
    return with_review_times(with_answer_times(dashboard_orders(wide, cutoff)))
