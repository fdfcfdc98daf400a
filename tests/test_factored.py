"""Counted rows against the rows of the wide join."""

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartlens.operators import aggregates as agg
from cartlens.plans import factored, kpis, wide
from cartlens.plans.features import customer_rollup, order_facts, product_behaviour


@pytest.fixture(scope="module")
def tables(spark):
    """Small random tables in which every order has several rows in every part, some none, some unknown values."""
    r = random.Random(5)

    def frame(data, schema):
        return spark.createDataFrame(data, schema)

    def stamp(k):
        return f"2018-0{1 + k % 8}-0{1 + k % 9} {k % 24:02d}:15:00"

    ids = [f"o{k}" for k in range(160)]
    orders = [(o, f"c{k}", "delivered" if k % 5 else "shipped", stamp(k), stamp(k + 1), stamp(k + 2), stamp(k + 3) if k % 7 else None, stamp(k + 6))
              for k, o in enumerate(ids)]
    customers = [(f"c{k}", f"p{k % 9}", k % 6, f"city{k % 4}" if k % 11 else None, f"S{k % 3}") for k in range(160)]
    items = [(o, n, f"w{r.randrange(6)}", f"s{r.randrange(4)}", stamp(n), r.choice([None, 1.005, 10.0, 3.33]), r.choice([0.1, 2.0]))
             for o in ids for n in range(r.randrange(4))]
    payments = [(o, n, r.choice(["card", "cash", None]), r.randrange(5), r.choice([None, 0.001, 7.5])) for o in ids for n in range(r.randrange(4))]
    reviews = [(f"r{o}{n}", o, r.choice([1, 3, 5]), stamp(n + 3), stamp(n + 4)) for o in ids for n in range(r.randrange(3))]
    sellers = [(f"s{k}", k, f"city{k}", f"S{k}") for k in range(3)]
    products = [(f"w{k}", f"cat{k % 3}" if k else None, *[float(k + j) if k != 2 else None for j in range(7)]) for k in range(6)]
    t = {
        "orders": frame(orders, "order_id string, customer_id string, order_status string, order_purchase_timestamp string, order_approved_at string, "
                        "order_delivered_carrier_date string, order_delivered_customer_date string, order_estimated_delivery_date string"),
        "customers": frame(customers, "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string"),
        "order_items": frame(items, "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date string, price double, "
                             "freight_value double"),
        "order_payments": frame(payments, "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double"),
        "order_reviews": frame(reviews, "review_id string, order_id string, review_score int, review_creation_date string, review_answer_timestamp string"),
        "sellers": frame(sellers, "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"),
        "products": frame(products, "product_id string, product_category_name string, product_name_lenght double, product_description_lenght double, "
                          "product_photos_qty double, product_weight_g double, product_length_cm double, product_height_cm double, product_width_cm double"),
        "category_translation": frame([("cat0", "zero"), ("cat1", "one"), ("unknown", "none")],
                                      "product_category_name string, product_category_name_english string"),
    }
    times = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]
    t["orders"] = t["orders"].withColumns({c: F.to_timestamp(c) for c in times})
    return t


CUTOFF = "2018-08"
FIGURES = {
    "cities": (kpis.cities_serviced, {"order": ["customer_city"]}),
    "days": (kpis.average_days_to_deliver, {"order": ["difference_purchased_delivered"]}),
    "delay": (kpis.delay_shares, {"order": ["delay_or_no_delay"]}),
    "states": (kpis.orders_per_state, {"order": ["customer_state"]}),
    "fastest": (kpis.fastest_cities, {"order": ["customer_city", "difference_purchased_delivered"]}),
    "sellers": (lambda v: kpis.sellers_per_city(v, 0), {"items": ["seller_id", "seller_state", "seller_city"]}),
    "people": (lambda v: kpis.customers_per_city(v, 0), {"order": ["customer_state", "customer_city", "customer_unique_id"]}),
    "totals": (kpis.customer_totals, {"order": ["customer_unique_id"], "totals": ["price"]}),
    "months": (kpis.orders_per_month, {"order": ["order_month_year"]}),
    "sales": (kpis.sales_per_month, {"order": ["order_month_year"], "totals": ["price"]}),
    "revenue": (kpis.category_revenue, {"items": ["product_category_name_english"], "totals": ["price"]}),
    "payments": (kpis.payments_by_month, {"order": ["order_month_year"], "payments": ["payment_type"], "totals": ["payment_value"]}),
    "baskets": (kpis.basket_sizes, {}),
    "answers": (kpis.answer_lag_shares, {"reviews": ["review_answer_time_difference_label"]}),
    "scores": (kpis.mean_score_by_delay, {"order": ["delay_or_no_delay"], "totals": ["review_score"]}),
    "live": (kpis.live_figures, {"totals": ["freight_value", "payment_value", "review_score"]}),
    "products": (kpis.top_products, {"items": ["product_id"], "totals": ["order_item_id"]}),
    "grid": (kpis.category_state_counts, {"order": ["customer_state"], "items": ["product_category_name_english"]}),
}


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12)
    return a == b


def equal(a, b):
    a, b = rows(a), rows(b)
    return len(a) == len(b) and all(len(x) == len(y) and all(map(close, x, y)) for x, y in zip(a, b))


@pytest.fixture(scope="module")
def view(tables):
    return wide.dashboard_view(wide.build_wide(tables, drop=False), CUTOFF).cache()


@pytest.mark.parametrize("name", FIGURES)
def test_figures_of_counted_rows(tables, view, name):
    figure, wanted = FIGURES[name]
    counted = factored.counted_rows(factored.dashboard_tables(tables, CUTOFF), **wanted)
    assert view.count() > 100
    assert equal(figure(counted), figure(view))


def test_first_reviews(tables, view):
    counted = factored.counted_rows(factored.dashboard_tables(tables, CUTOFF), ["order_delivered_customer_date"], reviews=kpis.FIRST_REVIEW)
    assert equal(kpis.review_lag_shares(wide.with_review_times(counted)), kpis.review_lag_shares(view))


def test_facts_rollup_and_products(tables):
    cleaned = wide.cleaned_tables(tables, drop=False)
    plain = wide.build_wide(tables, drop=False)
    columns = order_facts(plain).columns
    assert equal(factored.order_facts(cleaned).select(columns), order_facts(plain))
    expected = customer_rollup(wide.with_intervals(plain))
    assert equal(factored.rollup(cleaned).select(expected.columns), expected)
    assert equal(factored.behaviour(cleaned, None), product_behaviour(plain, None))


def test_two_parts_with_keys(tables):
    raw = wide.raw_tables(tables)
    counted = factored.counted_rows(raw, reviews=["review_score"], payments=["payment_type"])
    plain = wide.raw_wide(tables)
    assert equal(agg.crosstab(counted, "review_score", "payment_type"), agg.crosstab(plain, "review_score", "payment_type"))


def test_unknown_total_is_an_error(tables):
    with pytest.raises(ValueError, match="nothing"):
        factored.counted_rows(tables, totals=["nothing"])


def test_an_order_with_thousands_of_rows_in_every_table(spark, tables):
    """2.7e10 joined rows are counted from nine thousand; the wide join could not make them."""
    many = spark.range(3000)
    t = dict(tables)
    t["order_items"] = tables["order_items"].filter("order_id = 'none'").union(
        many.selectExpr("'o1'", "cast(id as int)", "'w1'", "'s1'", "'x'", "cast(id % 7 as double)", "0.5D"))
    t["order_payments"] = many.selectExpr("'o1' as order_id", "cast(id as int) as payment_sequential", "'card' as payment_type",
                                          "1 as payment_installments", "2.0D as payment_value")
    t["order_reviews"] = many.selectExpr("cast(id as string) as review_id", "'o1' as order_id", "cast(id % 5 as int) as review_score",
                                         "timestamp'2018-03-01' as review_creation_date", "timestamp'2018-03-02' as review_answer_timestamp")
    counted = factored.counted_rows(wide.cleaned_tables(t, drop=False), totals=["price", "review_score"])
    one = counted.collect()
    assert len(one) == 1 and one[0]["joined_rows"] == 27_000_000_000
    assert one[0]["price"] == sum(k % 7 for k in range(3000)) * 9_000_000
    assert counted.agg(agg.row_mean(counted, "review_score")).first()[0] == 2.0


def test_the_plan_joins_reduced_tables(spark, folder):
    """Every multiplying table is aggregated below its join."""
    from cartlens.catalog.registry import Data

    counted = Data(spark, folder).counted_view("weekday")
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [k for k, line in enumerate(plan.split("\n")) if "Aggregate [order_id" in line]
    assert len(aggregates) == 3
    assert counted.count() == counted.select("order_id").distinct().count()
