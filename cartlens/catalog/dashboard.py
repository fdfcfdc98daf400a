"""K: dashboard figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartlens.catalog.base_sql import answer_lag, days, money, review_lag
from cartlens.catalog.registry import Data, query, rounded
from cartlens.functions import dates
from cartlens.operators import aggregates as agg
from cartlens.operators import profile
from cartlens.plans import kpis, rfm
from cartlens.plans.wide import with_review_times

SHARE = "round(100.0::DOUBLE * n / (SELECT sum(n) FROM g), {digits}) AS share"


def _share(key: str, source: str = "dash", digits: int = 2, extra: str = "") -> str:
    return (
        f"WITH g AS (SELECT {key}, count(*) AS n FROM {source} WHERE {key} IS NOT NULL GROUP BY {key}) "
        f"SELECT {key}, n, {SHARE.format(digits=digits)} FROM g {extra}"
    )


def _seller_places(d: Data):
    return d.counted_view(items=["seller_id", "seller_state", "seller_city"])


def _people(d: Data):
    return d.counted_view("customer_state", "customer_city", "customer_unique_id")


def _category_sales(d: Data):
    return d.counted_view(items=["product_category_name_english"], totals=["price"])


def _category_states(d: Data):
    return d.counted_wide("customer_state", items=["product_category_name_english"])


def _reviewed(d: Data):
    return with_review_times(d.counted_view("order_delivered_customer_date", reviews=kpis.FIRST_REVIEW))


@query("k1_cities_serviced", "SELECT count(DISTINCT customer_city) + max(CASE WHEN customer_city IS NULL THEN 1 ELSE 0 END) AS cities FROM dash")
def k1(d: Data):
    return kpis.cities_serviced(d.counted_view("customer_city"))


@query("k2_average_days_to_deliver", "SELECT CAST(round_even(avg(difference_purchased_delivered), 0) AS INTEGER) AS days_to_deliver FROM dash")
def k2(d: Data):
    return kpis.average_days_to_deliver(d.counted_view("difference_purchased_delivered"))


@query("k3_delay_shares", _share("delay_or_no_delay"))
def k3(d: Data):
    return kpis.delay_shares(d.counted_view("delay_or_no_delay"))


@query(
    "k3_on_time_percent",
    "SELECT round(100.0::DOUBLE * count(*) FILTER (WHERE delay_or_no_delay = 'No Delay') / count(*), 2) AS on_time_percent FROM dash",
)
def k3b(d: Data):
    return kpis.on_time_percent(d.counted_view("delay_or_no_delay"))


@query("k4_orders_per_state", "SELECT customer_state, count(DISTINCT order_id) AS orders FROM dash GROUP BY customer_state")
def k4(d: Data):
    return kpis.orders_per_state(d.counted_view("customer_state"))


def _cities(column: str) -> str:
    return (
        f"SELECT customer_city, round(avg({column}), 6) AS mean_days FROM dash GROUP BY customer_city "
        "ORDER BY mean_days, customer_city LIMIT 5"
    )


@query("k5_fastest_cities", _cities("difference_purchased_delivered"))
def k5(d: Data):
    return rounded(kpis.fastest_cities(d.counted_view("customer_city", "difference_purchased_delivered")), 6, "mean_days")


@query("k6_most_delayed_cities", _cities("estimated_delivered_difference"))
def k6(d: Data):
    return rounded(kpis.most_delayed_cities(d.counted_view("customer_city", "estimated_delivered_difference")), 6, "mean_days")


_SELLERS = """SELECT seller_state, seller_city, count(DISTINCT seller_id) AS sellers FROM dash
              GROUP BY seller_state, seller_city HAVING count(DISTINCT seller_id) > 0"""
_PEOPLE = """SELECT customer_state, customer_city, count(customer_unique_id) AS customers FROM dash
             GROUP BY customer_state, customer_city HAVING count(customer_unique_id) >= 20"""


@query("k7_sellers_per_city", _SELLERS)
def k7(d: Data):
    return kpis.sellers_per_city(_seller_places(d), more_than=0)


@query(
    "k7_sellers_by_state_and_city",
    f"""WITH g AS ({_SELLERS}) SELECT seller_state, seller_city, CAST(sum(sellers) AS BIGINT) AS sellers,
        CAST(grouping(seller_state, seller_city) AS INTEGER) AS level FROM g GROUP BY ROLLUP (seller_state, seller_city)""",
)
def k7b(d: Data):
    return agg.state_city_totals(kpis.sellers_per_city(_seller_places(d), 0), "seller_state", "seller_city", "sellers")


@query("k8_customers_per_city", _PEOPLE)
def k8(d: Data):
    return kpis.customers_per_city(_people(d), at_least=20)


@query(
    "k8_customers_by_state_and_city",
    f"""WITH g AS ({_PEOPLE}) SELECT customer_state, customer_city, CAST(sum(customers) AS BIGINT) AS customers,
        CAST(grouping(customer_state, customer_city) AS INTEGER) AS level FROM g GROUP BY ROLLUP (customer_state, customer_city)""",
)
def k8b(d: Data):
    return agg.state_city_totals(kpis.customers_per_city(_people(d), 20), "customer_state", "customer_city", "customers")


@query(
    "k9_customer_totals",
    f"""SELECT count(DISTINCT customer_unique_id) AS customers,
        round({money('price')} / count(DISTINCT customer_unique_id), 2) AS revenue_per_customer,
        round(CAST(count(DISTINCT order_id) AS DOUBLE) / count(DISTINCT customer_unique_id), 2) AS orders_per_customer FROM dash""",
)
def k9(d: Data):
    return kpis.customer_totals(d.counted_view("customer_unique_id", totals=["price"]))


@query("k10_orders_per_month", "SELECT order_month_year, count(*) AS n FROM dash GROUP BY order_month_year")
def k10(d: Data):
    return kpis.orders_per_month(d.counted_view("order_month_year"))


@query("k11_sales_per_month", f"SELECT order_month_year, {money('price')} AS sales FROM dash GROUP BY order_month_year")
def k11(d: Data):
    return kpis.sales_per_month(d.counted_view("order_month_year", totals=["price"]))


@query(
    "k12_customers_per_month",
    "SELECT order_month_year, count(DISTINCT customer_unique_id) AS customers FROM dash GROUP BY order_month_year",
)
def k12(d: Data):
    return kpis.customers_per_month(d.counted_view("order_month_year", "customer_unique_id"))


_REVENUE = f"""WITH g AS (SELECT product_category_name_english, {money('price')} AS revenue FROM dash
               WHERE product_category_name_english IS NOT NULL GROUP BY 1),
          s AS (SELECT *, round(100.0::DOUBLE * revenue / (SELECT sum(revenue) FROM g), 2) AS share FROM g)"""


@query("k13_category_revenue", _REVENUE + " SELECT * FROM s")
def k13(d: Data):
    return kpis.category_revenue(_category_sales(d))


@query(
    "k13_top_category",
    _REVENUE
    + """ SELECT (SELECT count(*) FROM g) AS categories, product_category_name_english AS top_category, share FROM s
          ORDER BY revenue DESC, product_category_name_english LIMIT 1""",
)
def k13b(d: Data):
    return kpis.top_category(_category_sales(d))


@query(
    "k14_payments_by_month",
    f"""WITH m AS (SELECT DISTINCT order_month_year FROM dash), p AS (SELECT DISTINCT payment_type FROM dash),
        g AS (SELECT order_month_year, payment_type, {money('payment_value')} AS total FROM dash GROUP BY ALL)
        SELECT order_month_year, payment_type, coalesce(total, 0) AS total FROM (SELECT * FROM m, p)
        LEFT JOIN g USING (order_month_year, payment_type)""",
)
def k14(d: Data):
    return kpis.payments_by_month(d.counted_view("order_month_year", payments=["payment_type"], totals=["payment_value"]))


@query(
    "k15_top_categories_by_items",
    "SELECT product_category_name_english, share FROM ("
    + _share("product_category_name_english", extra="ORDER BY n DESC, product_category_name_english LIMIT 5")
    + ")",
)
def k15(d: Data):
    return kpis.top_categories_by_items(d.counted_view(items=["product_category_name_english"]))


@query(
    "k16_weekday_shares",
    f"""WITH l AS (SELECT CAST(i - 1 AS INTEGER) AS position,
              ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][i] AS weekday FROM range(1, 8) r(i)),
        s AS ({_share('weekday')})
        SELECT position, weekday, share FROM l LEFT JOIN s USING (weekday)""",
)
def k16(d: Data):
    return kpis.weekday_shares(d.counted_view("weekday"))


@query("k17_hour_shares", _share("order_purchase_hour"))
def k17(d: Data):
    return kpis.hour_shares(d.counted_view("order_purchase_hour"))


@query(
    "k18_price_histogram",
    """WITH b AS (SELECT min(price) AS lo, (max(price) - min(price)) / 1000.0::DOUBLE AS w FROM dash)
       SELECT CAST(least(floor((price - lo) / w), 999) AS INTEGER) AS bin, count(*) AS n FROM dash, b GROUP BY 1""",
)
def k18(d: Data):
    return profile.histogram(d.counted_view(items=["price"]), "price", 1000).select("bin", "n")


@query(
    "k18_basket_sizes",
    "SELECT basket_size, count(*) AS orders FROM (SELECT order_id, count(*) AS basket_size FROM dash GROUP BY order_id) GROUP BY basket_size",
)
def k18b(d: Data):
    return kpis.basket_sizes(d.counted_view())


@query(
    "k19_reviewed_percent",
    """WITH m AS (SELECT count(*) AS n FROM (SELECT DISTINCT order_id FROM d_orders) o ANTI JOIN c_some_reviews USING (order_id)),
       t AS (SELECT count(DISTINCT order_id) AS n FROM d_orders)
       SELECT t.n - m.n AS reviewed, m.n AS not_reviewed, round((t.n - m.n) * 100.0::DOUBLE / t.n, 2) AS reviewed_percent FROM m, t""",
)
def k19(d: Data):
    from cartlens.plans.wide import clean_orders

    return kpis.reviewed_percent(clean_orders(d["orders"]), d["some_reviews"])


def _lags(label: str, source: str, order: tuple[str, ...], key: str) -> str:
    listed = ", ".join(f"'{v}'" for v in order)
    return f"""WITH l AS (SELECT CAST(i - 1 AS INTEGER) AS position, [{listed}][i] AS {key} FROM range(1, {len(order) + 1}) r(i)),
        c AS (SELECT {label} AS {key}, count(*) AS n FROM {source} GROUP BY 1)
        SELECT position, {key}, n, round(100.0::DOUBLE * n / (SELECT sum(n) FROM c), 6) AS share FROM l LEFT JOIN c USING ({key})"""


@query(
    "k20_review_lag_shares",
    _lags(
        review_lag("delivery_review_time_difference"),
        """(SELECT DISTINCT ON (order_id) order_id, delivery_review_time_difference FROM dash
            ORDER BY order_id, review_creation_date, review_id)""",
        ("Within 1 day", "Within 1 Week", "Within 1 Month", "After 1 Month", "Before Delivery"),
        "delivery_review_time_difference_label",
    ),
)
def k20(d: Data):
    return rounded(kpis.review_lag_shares(_reviewed(d)), 6, "share")


@query(
    "k20_answer_lag_shares",
    _lags(
        answer_lag("review_answer_time_difference"),
        "dash",
        ("Within 1 day", "Within 2 days", "Within 1 Week", "Within 1 Month", "After 1 Month"),
        "review_answer_time_difference_label",
    ),
)
def k20b(d: Data):
    return rounded(kpis.answer_lag_shares(d.counted_view(reviews=["review_answer_time_difference_label"])), 6, "share")


@query(
    "k21_score_shares",
    """WITH last AS (SELECT DISTINCT ON (order_id) order_id, review_score FROM c_some_reviews SEMI JOIN d_orders USING (order_id)
                     ORDER BY order_id, review_creation_date DESC, review_id DESC),
       g AS (SELECT CAST(review_score AS VARCHAR) AS score, count(*) AS n FROM last GROUP BY 1
             UNION ALL SELECT 'No review', count(*) FROM d_orders ANTI JOIN c_some_reviews USING (order_id))
       SELECT score, n, round(100.0::DOUBLE * n / (SELECT sum(n) FROM g), 6) AS share FROM g""",
)
def k21(d: Data):
    from cartlens.plans.wide import clean_orders

    return rounded(kpis.score_shares(clean_orders(d["orders"]), d["some_reviews"]), 6, "share")


@query(
    "k22_mean_score_by_delay",
    "SELECT delay_or_no_delay, round(avg(review_score), 6) AS mean_score FROM dash GROUP BY delay_or_no_delay",
)
def k22(d: Data):
    return rounded(kpis.mean_score_by_delay(d.counted_view("delay_or_no_delay", totals=["review_score"])), 6, "mean_score")


@query(
    "k23_live_figures",
    f"""SELECT round({money('freight_value')} / count(freight_value), 6) AS average_freight, {money('payment_value')} AS total_payment,
        round(avg(review_score), 6) AS average_score, {money('freight_value')} AS total_freight FROM raw_wide""",
)
def k23(d: Data):
    return rounded(kpis.live_figures(d.counted_raw(totals=["freight_value", "payment_value", "review_score"])), 6, "average_freight", "average_score")


@query(
    "k24_top_products",
    "SELECT product_id, count(order_item_id) AS items FROM wide GROUP BY product_id ORDER BY items DESC, product_id LIMIT 10",
)
def k24(d: Data):
    return kpis.top_products(d.counted_wide(items=["product_id"], totals=["order_item_id"]))


_CATEGORY_STATE = "SELECT product_category_name_english, customer_state, count(*) AS counts FROM wide GROUP BY ALL"


@query("k25_category_state_counts", _CATEGORY_STATE)
def k25(d: Data):
    return kpis.category_state_counts(_category_states(d))


@query(
    "k25_top_category_state_counts",
    f"""WITH g AS ({_CATEGORY_STATE}) SELECT * FROM g WHERE product_category_name_english IN
        (SELECT product_category_name_english FROM g GROUP BY 1 ORDER BY sum(counts) DESC, 1 LIMIT 3)""",
)
def k25b(d: Data):
    return kpis.category_state_counts(_category_states(d), top=3)


@query(
    "k26_customer_coverage",
    """SELECT customer_state, count(DISTINCT customer_city) AS cities, count(DISTINCT customer_zip_code_prefix) AS zip_codes,
       count(DISTINCT customer_unique_id) AS people, count(DISTINCT customer_id) AS customer_ids FROM c_customers GROUP BY customer_state""",
)
def k26(d: Data):
    return kpis.customer_coverage(d["customers"])


@query(
    "k26_geolocation_coverage",
    """SELECT geolocation_state, count(DISTINCT geolocation_city) AS cities, count(DISTINCT geolocation_zip_code_prefix) AS zip_codes,
       count(DISTINCT geolocation_lng) AS longitudes, count(DISTINCT geolocation_lat) AS latitudes,
       count(DISTINCT CAST(geolocation_lng AS VARCHAR) || CAST(geolocation_lat AS VARCHAR)) AS points
       FROM c_geolocation GROUP BY geolocation_state""",
)
def k26b(d: Data):
    return kpis.geolocation_coverage(d["geolocation"])


@query("k27_segment_counts", "SELECT segment, count(*) AS n FROM scored WHERE segment IS NOT NULL GROUP BY segment")
def k27(d: Data):
    return rfm.segment_counts(rfm.rfm_scores(d.facts))


@query("k27_score_segment_counts", "SELECT rfm_score, segment, count(*) AS n FROM scored GROUP BY rfm_score, segment")
def k27b(d: Data):
    return rfm.score_segment_counts(rfm.rfm_scores(d.facts))


@query(
    "k28_late_percent",
    "SELECT round(avg(CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END) * 100, 6) AS late_percent FROM wide",
)
def k28(d: Data):
    return rounded(kpis.late_percent(d.counted_wide("order_delivered_customer_date", "order_estimated_delivery_date")), 6, "late_percent")


@query(
    "k29_rows_with_zero_recency",
    f"""SELECT count(*) AS n FROM wide
        WHERE {days('(SELECT max(order_purchase_timestamp) FROM wide)', 'order_purchase_timestamp')} = 0""",
)
def k29(d: Data):
    recency = dates.whole_days(d.facts.latest, F.col("order_purchase_timestamp"))
    return d.facts.orders.filter(recency == 0).agg(F.sum("n_rows").alias("n"))


@query(
    "k29_top_review_titles",
    """SELECT review_comment_title, count(*) AS n FROM raw_wide WHERE review_comment_title IS NOT NULL GROUP BY 1
       ORDER BY n DESC, review_comment_title LIMIT 10""",
)
def k29b(d: Data):
    return agg.top_k(agg.counts(d.counted_raw(reviews=["review_comment_title"]), "review_comment_title"), "n", 10, ["review_comment_title"])


@query(
    "k30_delivery_margin_profile",
    """WITH m AS (SELECT (epoch_us(order_estimated_delivery_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0::DOUBLE
                       - (epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0::DOUBLE AS x FROM c_orders)
       SELECT 'margin' AS "column", count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(min(x), 6) AS min,
              round(quantile_cont(x, 0.25), 6) AS q25, round(median(x), 6) AS median, round(quantile_cont(x, 0.75), 6) AS q75,
              round(max(x), 6) AS max FROM m""",
)
def k30(d: Data):
    bought = F.col("order_purchase_timestamp")
    margin = dates.days_between(F.col("order_estimated_delivery_date"), bought) - dates.days_between(
        F.col("order_delivered_customer_date"), bought
    )
    margins = d["orders"].select(margin.alias("margin"))
    return rounded(profile.numeric_profile(margins, ["margin"]), 6, "mean", "std", "min", "q25", "median", "q75", "max")
