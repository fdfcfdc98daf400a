"""Dashboard figures. Inputs are rows of plans.wide.dashboard_view unless said otherwise, so
counts are at joined-row grain where the dashboard counts joined rows. Rows may be plain, or counted
by plans.factored, where those of the wide join are never made."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.functions import labels
from cartlens.operators import aggregates as agg
from cartlens.operators import clean

FIRST_REVIEW = ("review_creation_date", "review_id")


# -- geography ---------------------------------------------------------------------------


def cities_serviced(view: DataFrame) -> DataFrame:
    """Distinct cities; an unknown city counts as one more."""
    return view.agg(
        (F.count_distinct("customer_city") + F.coalesce(F.max(F.col("customer_city").isNull().cast("int")), F.lit(0)))
        .cast("bigint")
        .alias("cities")
    )


def average_days_to_deliver(view: DataFrame) -> DataFrame:
    """Mean whole days, rounded half to even."""
    return view.agg(F.bround(agg.row_mean(view, "difference_purchased_delivered"), 0).cast("int").alias("days_to_deliver"))


def delay_shares(view: DataFrame) -> DataFrame:
    return agg.frequencies(view, "delay_or_no_delay", digits=2)


def on_time_percent(view: DataFrame) -> DataFrame:
    return delay_shares(view).filter(F.col("delay_or_no_delay") == labels.NO_DELAY).select(F.col("share").alias("on_time_percent"))


def orders_per_state(view: DataFrame) -> DataFrame:
    known = agg.keyed(view, ["customer_state"])
    return known.groupBy("customer_state").agg(F.count_distinct("order_id").alias("orders"))


def cities_by_mean(view: DataFrame, column: str, k: int = 5) -> DataFrame:
    """The k cities with the lowest mean of a day column."""
    means = agg.keyed(view, ["customer_city"]).groupBy("customer_city").agg(agg.row_mean(view, column).alias("mean_days"))
    return agg.top_k(means.filter(F.col("mean_days").isNotNull()), "mean_days", k, ["customer_city"], ascending=True)


def fastest_cities(view: DataFrame, k: int = 5) -> DataFrame:
    return cities_by_mean(view, "difference_purchased_delivered", k)


def most_delayed_cities(view: DataFrame, k: int = 5) -> DataFrame:
    return cities_by_mean(view, "estimated_delivered_difference", k)


def sellers_per_city(view: DataFrame, more_than: int = 20) -> DataFrame:
    known = agg.keyed(view, ["seller_state", "seller_city"])
    sellers = known.groupBy("seller_state", "seller_city").agg(F.count_distinct("seller_id").alias("sellers"))
    return sellers.filter(F.col("sellers") > more_than)


def customers_per_city(view: DataFrame, at_least: int = 500) -> DataFrame:
    """Joined rows with a known person per city, as the dashboard counts them."""
    known = agg.keyed(view, ["customer_state", "customer_city"])
    people = known.groupBy("customer_state", "customer_city").agg(agg.row_count(view, "customer_unique_id").alias("customers"))
    return people.filter(F.col("customers") >= at_least)


# -- trend -------------------------------------------------------------------------------


def customer_totals(view: DataFrame) -> DataFrame:
    one = view.agg(
        F.count_distinct("customer_unique_id").alias("customers"),
        F.count_distinct("order_id").alias("orders"),
        agg.money_sum("price").alias("revenue"),
    )
    return one.select(
        "customers",
        F.round(F.try_divide(F.col("revenue"), F.col("customers")), 2).alias("revenue_per_customer"),
        F.round(F.try_divide(F.col("orders").cast("double"), F.col("customers")), 2).alias("orders_per_customer"),
    )


def orders_per_month(view: DataFrame) -> DataFrame:
    return agg.counts(view, "order_month_year").orderBy("order_month_year")


def sales_per_month(view: DataFrame) -> DataFrame:
    return view.groupBy("order_month_year").agg(agg.money_sum("price").alias("sales")).orderBy("order_month_year")


def customers_per_month(view: DataFrame) -> DataFrame:
    people = view.groupBy("order_month_year").agg(F.count_distinct("customer_unique_id").alias("customers"))
    return people.orderBy("order_month_year")


# -- preference --------------------------------------------------------------------------


def category_revenue(view: DataFrame) -> DataFrame:
    """Revenue and its percent share per category."""
    known = agg.keyed(view, ["product_category_name_english"])
    revenue = known.groupBy("product_category_name_english").agg(agg.money_sum("price").alias("revenue"))
    return agg.share_of_total(revenue, "revenue", "share", 2)


def top_category(view: DataFrame) -> DataFrame:
    """Number of categories, and the one with the most revenue with its share."""
    revenue = category_revenue(view)
    number = revenue.agg(F.count(F.lit(1))).scalar()
    best = agg.top_k(revenue, "revenue", 1, ["product_category_name_english"])
    return best.select(number.alias("categories"), F.col("product_category_name_english").alias("top_category"), "share")


def payments_by_month(view: DataFrame) -> DataFrame:
    """Payment total for every month with every payment type."""
    return agg.dense_grid(view, "order_month_year", "payment_type", "payment_value")


def top_categories_by_items(view: DataFrame, k: int = 5) -> DataFrame:
    shares = agg.frequencies(view, "product_category_name_english")
    best = agg.top_k(shares, "n", k, ["product_category_name_english"])
    return best.select("product_category_name_english", F.round("share", 2).alias("share"))


def weekday_shares(view: DataFrame) -> DataFrame:
    """Percent of rows per weekday, Monday first."""
    shares = agg.frequencies(view, "weekday", digits=2).select("weekday", "share")
    return agg.align_to(shares, "weekday", labels.WEEKDAYS)


def hour_shares(view: DataFrame) -> DataFrame:
    return agg.frequencies(view, "order_purchase_hour", digits=2).orderBy("order_purchase_hour")


def basket_sizes(view: DataFrame) -> DataFrame:
    """Orders per number of joined item rows."""
    return agg.counts(agg.counts(view, "order_id", name="basket_size"), "basket_size", name="orders")


# -- reviews -----------------------------------------------------------------------------


def reviewed_percent(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Percent of orders with a review."""
    marked = reviews.select("order_id").distinct().withColumn("__reviewed", F.lit(1))
    found = orders.select("order_id").distinct().join(marked, "order_id", "left")
    one = found.agg(F.count("__reviewed").alias("reviewed"), F.count_if(F.col("__reviewed").isNull()).alias("not_reviewed"))
    total = F.col("reviewed") + F.col("not_reviewed")
    return one.withColumn("reviewed_percent", F.round(F.try_divide(F.col("reviewed") * 100.0, total), 2))


def review_lag_shares(view: DataFrame) -> DataFrame:
    """Percent of orders by the time from delivery to their first review."""
    narrow = view.select("order_id", *FIRST_REVIEW, "delivery_review_time_difference_label")
    first = clean.keep_one(narrow, ["order_id"], [*FIRST_REVIEW, "delivery_review_time_difference_label"])
    shares = agg.frequencies(first, "delivery_review_time_difference_label")
    return agg.align_to(shares, "delivery_review_time_difference_label", labels.REVIEW_LAG_ORDER)


def answer_lag_shares(view: DataFrame) -> DataFrame:
    shares = agg.frequencies(view, "review_answer_time_difference_label")
    return agg.align_to(shares, "review_answer_time_difference_label", labels.ANSWER_LAG_ORDER)


def score_shares(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Percent of orders by their last review's score, with a row for unreviewed orders."""
    of_orders = reviews.join(orders.select("order_id").distinct(), "order_id", "left_semi")
    last = clean.keep_one(of_orders.select("order_id", *FIRST_REVIEW, "review_score"), ["order_id"], FIRST_REVIEW, last=True)
    scored = agg.counts(last, "review_score").select(F.col("review_score").cast("string").alias("score"), "n")
    missing = agg.without(orders.select("order_id").distinct(), reviews, "order_id")
    row = missing.agg(F.lit("No review").alias("score"), F.count(F.lit(1)).alias("n"))
    return agg.share_of_total(agg.append_row(scored, row), "n", "share")


def mean_score_by_delay(view: DataFrame) -> DataFrame:
    return view.groupBy("delay_or_no_delay").agg(agg.row_mean(view, "review_score").alias("mean_score"))


def score_summary(view: DataFrame) -> DataFrame:
    """Mean, median and smallest most frequent review score, as rows. Scores are a handful of
    whole numbers, so the median and mode buffers hold a handful of counts."""
    return agg.measures_as_rows(
        view,
        {
            "Mean Review Score": F.avg("review_score"),
            "Median Review Score": F.median("review_score"),
            "Mode Review Score": F.mode("review_score", True),
        },
    )


# -- live and others ---------------------------------------------------------------------


def live_figures(rows: DataFrame) -> DataFrame:
    """Freight, payments and score over unfiltered rows."""
    return rows.agg(
        F.try_divide(agg.money_sum("freight_value"), agg.row_count(rows, "freight_value")).alias("average_freight"),
        agg.money_sum("payment_value").alias("total_payment"),
        agg.row_mean(rows, "review_score").alias("average_score"),
        agg.money_sum("freight_value").alias("total_freight"),
    )


def top_products(rows: DataFrame, k: int = 10) -> DataFrame:
    known = agg.keyed(rows, ["product_id"])
    sold = known.groupBy("product_id").agg(agg.row_count(rows, "order_item_id").alias("items"))
    return agg.top_k(sold, "items", k, ["product_id"])


def category_state_counts(rows: DataFrame, top: int | None = None) -> DataFrame:
    """Rows per category and state, optionally for the categories with most rows only."""
    grouped = agg.counts(rows, "product_category_name_english", "customer_state", name="counts")
    if top is None:
        return grouped
    return agg.keep_top_keys(grouped, "product_category_name_english", top, F.sum("counts"))


def customer_coverage(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_state").agg(
        F.count_distinct("customer_city").alias("cities"),
        F.count_distinct("customer_zip_code_prefix").alias("zip_codes"),
        F.count_distinct("customer_unique_id").alias("people"),
        F.count_distinct("customer_id").alias("customer_ids"),
    )


def geolocation_coverage(geolocation: DataFrame) -> DataFrame:
    from cartlens.functions.text import location_key

    points = geolocation.withColumn("lon_lat", location_key(F.col("geolocation_lng"), F.col("geolocation_lat")))
    return points.groupBy("geolocation_state").agg(
        F.count_distinct("geolocation_city").alias("cities"),
        F.count_distinct("geolocation_zip_code_prefix").alias("zip_codes"),
        F.count_distinct("geolocation_lng").alias("longitudes"),
        F.count_distinct("geolocation_lat").alias("latitudes"),
        F.count_distinct("lon_lat").alias("points"),
    )


def late_percent(rows: DataFrame) -> DataFrame:
    from cartlens.plans.features import late_column

    marked = rows.withColumn("late_deliveries", late_column())
    return marked.agg((agg.row_mean(marked, "late_deliveries") * 100.0).alias("late_percent"))


def live_sales(sales: DataFrame, minutes: int) -> DataFrame:
    """Transactions, orders and sales per timestamp and order in the last minutes before the newest
    sale. Sales are rounded to cents, then cut to whole units."""
    newest = sales.agg(F.max("created_date")).scalar()
    recent = sales.filter(F.col("created_date") >= newest - F.make_dt_interval(mins=F.lit(minutes)))
    return recent.groupBy("created_date", "salesordernumber").agg(
        F.count(F.lit(1)).alias("num_transactions"),
        F.count_distinct("salesordernumber").alias("num_orders"),
        F.round(agg.money_sum("salesamount"), 2).cast("int").alias("sales"),
    )


def live_totals(sales: DataFrame, periods: Sequence[int] = (60, 30, 10, 5)) -> DataFrame:
    """Grand totals of live_sales for several periods, from one pass over the longest."""
    newest = sales.agg(F.max("created_date")).scalar()
    return totals_of_groups(live_sales(sales, max(periods)), newest, periods)


def totals_of_groups(groups: DataFrame, newest: Column, periods: Sequence[int]) -> DataFrame:
    """Totals per period before the newest sale, from rows of live_sales."""
    period = F.explode(F.array(*[F.lit(p) for p in periods])).alias("minutes")
    spread = groups.select("*", period).filter(
        F.col("created_date") >= newest - F.make_dt_interval(mins=F.col("minutes"))
    )
    return spread.groupBy("minutes").agg(
        F.sum("num_transactions").alias("num_transactions"),
        F.sum("num_orders").alias("num_orders"),
        F.sum("sales").cast("bigint").alias("sales"),
    )
