"""The wide table, features, RFM, KPIs and evaluation on a tiny hand-made shop; plan checks."""

import math
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartlens import schemas
from cartlens.operators import evaluation
from cartlens.models import churn
from cartlens.plans import explore, factored, kpis, rfm, wide
from cartlens.plans.features import CustomerFacts, customer_rollup, late_per_customer


def at(day, hour=0):
    return datetime(2018, 1, day, hour)


@pytest.fixture(scope="module")
def shop(spark):
    """Person P1 has two orders, P2 one; one order is not delivered, one review is incomplete."""
    orders = [
        ("o1", "c1", "delivered", at(1, 10), at(1, 12), at(2), at(5), at(4)),
        ("o2", "c2", "delivered", at(11), at(11, 1), at(12), None, at(20)),
        ("o3", "c3", "delivered", at(21, 23), at(22), at(23), at(24, 11), at(25)),
        ("o4", "c4", "shipped", at(22), None, None, None, at(30)),
        ("o5", "c5", "delivered", at(23), None, None, at(24), at(30)),
    ]
    customers = [(f"c{i}", p, i, f"city{i % 2}", s) for i, p, s in
                 [(1, "P1", "SP"), (2, "P1", "SP"), (3, "P2", "RS"), (4, "P2", "RS"), (5, "P3", "AM")]]
    items = [
        ("o1", 1, "p1", "s1", at(3), 10.0, 1.0), ("o1", 2, "p2", "s1", at(3), 20.0, 2.0),
        ("o2", 1, "p1", "s2", at(13), 10.0, 1.5), ("o3", 1, "p2", "s2", at(23), 20.0, 2.5),
        ("o4", 1, "p1", "s1", at(24), 10.0, 1.0), ("o5", 1, "p3", "s1", at(24), 5.0, 1.0),
    ]
    payments = [("o1", 1, "card", 2, 25.0), ("o1", 2, "voucher", 1, 8.0), ("o2", 1, "card", 1, 11.5),
                ("o3", 1, "boleto", 1, 22.5), ("o4", 1, "card", 1, 11.0), ("o5", 1, "card", 1, 6.0)]
    text_at = lambda d, h=0: at(d, h).strftime("%Y-%m-%d %H:%M:%S")
    reviews = [
        ("r1", "o1", 2, None, None, text_at(6), text_at(6, 12)),
        ("r2", "o2", 5, "good", None, text_at(12), text_at(20)),
        ("r3", "o3", 4, None, None, text_at(24, 12), text_at(24, 11)),
        ("r5", "o5", 3, None, None, text_at(25), None),
    ]
    sellers = [("s1", 1, "city0", "SP"), ("s2", 2, "city1", "RJ")]
    products = [("p1", "brinquedos", *[1.0] * 7), ("p2", "casa", *[2.0] * 7), ("p3", None, *[3.0] * 7)]
    translation = [("brinquedos", "toys"), ("casa", "home")]
    data = dict(orders=orders, customers=customers, order_items=items, order_payments=payments, order_reviews=reviews,
                sellers=sellers, products=products, category_translation=translation)
    return {k: spark.createDataFrame(v, schemas.TABLES[k]) for k, v in data.items()}


@pytest.fixture(scope="module")
def joined(shop):
    return wide.build_wide(shop, drop=False)


@pytest.fixture(scope="module")
def facts(joined):
    return CustomerFacts(joined)


def test_items_payments_and_reviews_multiply(shop):
    got = wide.build_wide(shop)
    # o1: 2 items x 2 payments; o4 is not delivered; o5's review is incomplete
    assert got.groupBy("order_id").count().orderBy("order_id").collect() == [("o1", 4), ("o2", 1), ("o3", 1)]
    for dropped in (*wide.ORDER_DROPS, *wide.PRODUCT_DROPS, *wide.REVIEW_DROPS, *wide.SELLER_DROPS):
        assert dropped not in got.columns


def test_unknown_category_has_no_translation(shop):
    reviews = shop["order_reviews"].na.fill("2018-01-26 00:00:00", ["review_answer_timestamp"])
    got = wide.build_wide({**shop, "order_reviews": reviews})
    assert got.filter("order_id = 'o5'").count() == 0
    cleaned = wide.clean_products(shop["products"])
    assert {r[0] for r in cleaned.select("product_category_name").collect()} == {"brinquedos", "casa", "unknown"}


def test_missing_delivery_is_taken_from_estimate(joined):
    got = joined.filter("order_id = 'o2'").select("order_delivered_customer_date").first()[0]
    assert got == at(20)


def test_customer_features(facts):
    got = {r["customer_unique_id"]: r for r in facts.customers.collect()}
    p1, p2 = got["P1"], got["P2"]
    # newest purchase is 21 Jan 23:00; P1's last is 11 Jan 00:00
    assert (p1["recency"], p1["frequency"], p1["num_orders"], p1["customer_tenure"]) == (10, 5, 2, 9)
    assert p1["monetary_value"] == 2 * (25.0 + 8.0) + 11.5  # payments repeat per item
    assert p1["late_deliveries"] == 4 and p2["late_deliveries"] == 0
    assert (p2["recency"], p2["frequency"], p2["monetary_value"], p2["customer_tenure"]) == (0, 1, 22.5, 0)


def test_row_grain_counts_every_row(facts, joined):
    assert facts.counted_rows.agg(F.sum("n_rows")).first()[0] == joined.count()
    got = rows(facts.counted_rows.select("customer_unique_id", "recency", "n_rows"))
    assert got == [("P1", 10, 1), ("P1", 20, 4), ("P2", 0, 1)]
    plain = facts.rows().groupBy("customer_unique_id", "recency").count()
    assert rows(plain) == got


def test_rollup_keeps_published_quirks(joined):
    got = {r["customer_unique_id"]: r for r in customer_rollup(wide.with_intervals(joined)).collect()}
    p1 = got["P1"]
    assert p1["order_id"] == 2 and p1["product_id"] == 2 and p1["num_orders"] == 1
    assert p1["monetary_value"] == 5 * 77.5 and p1["payment_value"] == 77.5 and p1["recency"] == 20
    assert p1["delivered_estimated"] == -1 and p1["late_deliveries"] == 4 and p1["payment_type"] == "voucher"


def test_late_rows_per_customer_id(facts):
    assert rows(late_per_customer(facts)) == [("c1", 4), ("c2", 0), ("c3", 0)]
    assert rows(rfm.late_segment_counts(late_per_customer(facts))) == [("High", 1), ("No Late Deliveries", 2)]


def test_rfm_score_is_the_sum(facts):
    scored = rfm.rfm_scores(facts)
    bad = scored.filter(F.col("rfm_score") != F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"))
    assert bad.count() == 0
    both = {r["customer_unique_id"]: r for r in rfm.rfm_scores(facts, "customer").collect()}
    flipped = {r["customer_unique_id"]: r for r in rfm.rfm_scores(facts, "customer", invert_recency=True).collect()}
    assert both["P1"]["recency_score"] > both["P2"]["recency_score"]
    assert flipped["P1"]["recency_score"] < flipped["P2"]["recency_score"]


def test_clv_weightings_differ(facts):
    row = rfm.historical_clv(facts).first()
    person = rfm.historical_clv(facts, "customer").first()
    assert math.isclose(row["purchase_frequency"], (5 * 5 + 1) / 6) and math.isclose(person["purchase_frequency"], 3.0)


def test_dashboard_view(joined):
    view = wide.dashboard_view(joined, "2018-02")
    got = {r["order_id"]: r for r in view.dropDuplicates(["order_id"]).collect()}
    assert got["o1"]["delay_or_no_delay"] == "Delay" and got["o1"]["difference_purchased_delivered"] == 3
    assert got["o1"]["review_answer_time_difference_label"] == "Within 1 day"
    # answered an hour before it was written: floor gives -1
    assert got["o3"]["review_answer_time_difference"] == -1
    assert got["o3"]["review_answer_time_difference_label"] == "Within 2 days"
    assert got["o2"]["delivery_review_time_difference_label"] == "Before Delivery"
    assert wide.dashboard_view(joined, "2018-01").count() == 0


def test_review_kpis(shop):
    delivered = wide.clean_orders(shop["orders"])
    without_r3 = shop["order_reviews"].filter("review_id <> 'r3'")
    assert tuple(kpis.reviewed_percent(delivered, without_r3).first()) == (3, 1, 75.0)
    got = {r["score"]: r["n"] for r in kpis.score_shares(delivered, without_r3).collect()}
    assert got == {"2": 1, "5": 1, "3": 1, "No review": 1}
    shares = kpis.score_shares(delivered, without_r3).agg(F.sum("share")).first()[0]
    assert math.isclose(shares, 100.0)


def test_cities_count_unknown_once(joined):
    view = wide.dashboard_view(joined, "2018-02")
    assert kpis.cities_serviced(view).first()[0] == 2
    unknown = view.withColumn("customer_city", F.when(F.col("order_id") != "o1", F.col("customer_city")))
    assert kpis.cities_serviced(unknown).first()[0] == unknown.select("customer_city").distinct().count()


def test_days_round_half_to_even(spark):
    df = spark.createDataFrame([(2,), (3,)], "difference_purchased_delivered int")
    assert kpis.average_days_to_deliver(df).first()[0] == 2


def test_live_sales(spark):
    data = [("2024-01-01 00:00:00", "a", 1.0), ("2024-01-01 00:55:00", "b", 2.75), ("2024-01-01 00:55:00", "b", 2.0),
            ("2024-01-01 01:00:00", "a", 3.999)]
    sales = spark.createDataFrame(data, "t string, salesordernumber string, salesamount double").select(
        F.to_timestamp("t").alias("created_date"), "salesordernumber", "salesamount")
    got = [(r["salesordernumber"], r["num_transactions"], r["num_orders"], r["sales"]) for r in kpis.live_sales(sales, 5).collect()]
    assert sorted(got) == [("a", 1, 1, 4), ("b", 2, 1, 4)]  # 4.75 is cut, 3.999 is rounded to cents first
    totals = {r["minutes"]: r["num_transactions"] for r in kpis.live_totals(sales).collect()}
    assert totals == {60: 4, 30: 3, 10: 3, 5: 3}


def test_delivery_comparison(shop):
    scored = shop["order_reviews"].select("order_id", "review_score").join(wide.with_intervals(shop["orders"]), "order_id")
    got = {r["metric"]: (r["on_time"], r["late"]) for r in explore.delivery_comparison(scored).collect()}
    assert got["review_score"] == (3.0, 2.0)  # o3 is early by 13 hours, which is zero whole days


def test_evaluation(spark):
    data = [(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.4), (0, 1, 0.8), (0, 0, 0.1), (1, 1, 0.8)]
    df = spark.createDataFrame(data, "label int, prediction int, score double")
    assert rows(evaluation.confusion_counts(df)) == [(0, 0, 2), (0, 1, 1), (1, 0, 1), (1, 1, 2)]
    report = {r["class"]: r for r in evaluation.classification_report(df).collect()}
    assert math.isclose(report["1"]["precision"], 2 / 3) and math.isclose(report["accuracy"]["f1"], 4 / 6)
    points = rows(evaluation.roc_points(df), F.desc("threshold"))
    want = [(0.0, 0.0), (0.0, 1 / 3), (1 / 3, 2 / 3), (2 / 3, 1.0), (1.0, 1.0)]
    assert [(round(f, 9), round(t, 9)) for _, f, t in points] == [(round(f, 9), round(t, 9)) for f, t in want]
    # pairs ranked rightly, ties count one half: (3 + 1.5 + 1 ... ) / 9
    pairs = [(a, b) for la, _, a in data if la == 1 for lb, _, b in data if lb == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs)
    assert math.isclose(evaluation.auc(df).first()[0], auc)
    nothing = evaluation.classification_report(df.filter("label = 0 and prediction = 0")).collect()
    assert {r["class"]: r["precision"] for r in nothing}["1"] == 0.0


# -- plans ---------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_pruned_scans(spark, folder):
    from cartlens.catalog.registry import Data

    d = Data(spark, folder)
    for df in (kpis.sales_per_month(d.view), kpis.review_lag_shares(d.view), d.facts.customers, kpis.customer_totals(d.view)):
        assert "Python" not in plan(df) and "ArrowEval" not in plan(df)
    text = plan(kpis.sales_per_month(d.view))
    scan = next(line for line in text.splitlines() if "lineitem" in line)
    assert "l_quantity" not in scan and "l_tax" not in scan and "l_extendedprice" in scan


def test_month_cutoff_and_status_reach_the_scan(spark, joined, tmp_path):
    joined.write.parquet(f"{tmp_path}/wide")
    stored = spark.read.parquet(f"{tmp_path}/wide")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(wide.dashboard_view(stored, "2018-02").select("price"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(order_status,delivered)" in text and "LessThan(order_purchase_timestamp" in text


def test_state_layout_prunes_partitions(spark, joined, tmp_path):
    from cartlens.sources import readers, writers

    writers.write_state_table(joined, "state_layout", f"{tmp_path}/t", files_per_state=3)
    stored = readers.read_table(spark, "state_layout", ["order_id", "customer_state"])
    filtered = stored.filter("customer_state = 'SP'")
    assert "PartitionFilters: [isnotnull(customer_state" in plan(filtered) and filtered.count() == 5
    spark.sql("drop table state_layout")


def test_shares_reuse_the_grouped_shuffle(spark, folder):
    from cartlens.catalog.registry import Data

    df = kpis.delay_shares(Data(spark, folder).view)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_joins_share_one_partitioning_on_the_order(spark, folder):
    """Without broadcasts, customers, payments, reviews and items need one shuffle per input
    and one for the joined rows; the three order joins follow each other without another."""
    from cartlens.catalog.registry import Data

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        text = plan(Data(spark, folder).wide.select("order_id", "price"))
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert text.count("hashpartitioning(order_id") == 4


def test_top_per_group_is_cut_before_the_shuffle(spark):
    from cartlens.operators.aggregates import top_per_group

    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    top = top_per_group(df, "k", 3, [F.desc("id")])
    assert "WindowGroupLimit" in plan(top)
    assert rows(top, "k", "place") == [(0, 998, 1), (0, 996, 2), (0, 994, 3), (1, 999, 1), (1, 997, 2), (1, 995, 3)]


def test_scratch_folder(spark, monkeypatch):
    from cartlens import session

    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")

    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://somewhere:7077"

    class Bare:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_folder(Bare())
    Context.master = "local[2]"
    assert session.shared_folder(Bare()) == session.shared_folder(Bare())


def test_wide_table_from_csv_files(spark, shop, joined, tmp_path):
    from cartlens.sources import readers, writers

    files = {}
    for name in wide.TABLE_NAMES:
        writers.write_csv(shop[name], f"{tmp_path}/{name}")
        files[name] = name
    tables = readers.read_csv_tables(spark, str(tmp_path), files)
    again = wide.build_wide(tables, drop=False)
    assert again.schema == joined.schema
    kept = [c for c in again.columns if "comment" not in c]  # empty text is written as null
    assert rows(again.select(kept)) == rows(joined.select(kept))


def test_bad_review_dates_are_dropped(spark, shop):
    spoiled = shop["order_reviews"].withColumn(
        "review_creation_date", F.when(F.col("review_id") == "r1", "no date").otherwise(F.col("review_creation_date"))
    )
    assert {r[0] for r in wide.clean_reviews(spoiled).select("review_id").collect()} == {"r2", "r3"}


def test_fence_of_an_empty_column(spark):
    from cartlens.operators import quantiles

    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    got = {r["column"]: (r["inliers"], r["outliers"]) for r in quantiles.iqr_counts(df, ["a", "b"]).collect()}
    assert got == {"a": (2, 0), "b": (0, 0)}


def test_training_rows_meet_their_persons_before_they_multiply(shop, facts):
    cleaned = wide.cleaned_tables(shop, drop=False)
    early = churn.labelled_rows(CustomerFacts(facts.wide, factored.order_facts(cleaned), cleaned))
    assert rows(early) == rows(churn.labelled_rows(facts)) and early.count() == 6
    plan = early._jdf.queryExecution().optimizedPlan().toString()
    # the joined rows are made distinct once, and never moved by person
    assert len([x for x in plan.splitlines() if "Aggregate [" in x and "price" in x]) == 1
