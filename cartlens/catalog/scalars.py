"""C: date, text, label and bucketing expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartlens.catalog.base_sql import answer_lag, days, review_lag
from cartlens.catalog.registry import Data, query, rounded
from cartlens.functions import buckets, dates, labels, text
from cartlens.operators import aggregates as agg
from cartlens.operators import ordered, profile
from cartlens.plans import rfm
from cartlens.session import scratch_path

_P, _D, _E = "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date"
_MICROS = f"(epoch_us({_D}) - epoch_us({_P}))"


def _reviews_with_delivery(d: Data):
    return d["order_reviews"].join(d["orders"].select("order_id", _P, _D, _E), "order_id")


_RD = f"rd AS (SELECT r.*, {_P}, {_D}, {_E} FROM c_reviews r JOIN c_orders USING (order_id))"


@query("c1_whole_days", f"WITH {_RD} SELECT review_id, CAST({days('review_answer_timestamp', 'review_creation_date')} AS DOUBLE) AS answer_days, CAST({days('review_creation_date', _D)} AS DOUBLE) AS review_days FROM rd")
def c1(d: Data):
    return _reviews_with_delivery(d).select(
        "review_id",
        dates.whole_days(F.col("review_answer_timestamp"), F.col("review_creation_date")).cast("double").alias("answer_days"),
        dates.whole_days(F.col("review_creation_date"), F.col(_D)).cast("double").alias("review_days"),
    )


@query("c2_fractional_days", f"SELECT order_id, round({_MICROS} / 86400000000.0::DOUBLE, 9) AS reach_time FROM c_orders")
def c2(d: Data):
    return rounded(d["orders"].select("order_id", dates.days_between(F.col(_D), F.col(_P)).alias("reach_time")), 9, "reach_time")


@query(
    "c3_weeks_months_years",
    f"""SELECT order_id, round({_MICROS} / 86400000000.0::DOUBLE / 7, 9) AS weeks,
        round({_MICROS} / 86400000000.0::DOUBLE / 30.436875::DOUBLE, 9) AS months,
        round({_MICROS} / 86400000000.0::DOUBLE / 365.2425::DOUBLE, 9) AS years FROM c_orders""",
)
def c3(d: Data):
    later, earlier = F.col(_D), F.col(_P)
    parts = d["orders"].select(
        "order_id",
        dates.weeks_between(later, earlier).alias("weeks"),
        dates.months_between_mean(later, earlier).alias("months"),
        dates.years_between_mean(later, earlier).alias("years"),
    )
    return rounded(parts, 9, "weeks", "months", "years")


@query(
    "c4_month",
    f"SELECT order_id, strftime({_P}, '%Y-%m') AS month, strftime(date_trunc('month', {_P}), '%Y-%m-%d') AS month_start FROM c_orders",
)
def c4(d: Data):
    return d["orders"].select(
        "order_id",
        dates.month_label(F.col(_P)).alias("month"),
        F.date_format(dates.month_start(F.col(_P)), "yyyy-MM-dd").alias("month_start"),
    )


@query("c5_weekday_name", f"SELECT order_id, dayname({_P}) AS weekday FROM c_orders")
def c5(d: Data):
    return d["orders"].select("order_id", dates.weekday_name(F.col(_P)).alias("weekday"))


@query("c6_iso_weekday", f"SELECT order_id, CAST(isodow({_P}) AS INTEGER) AS weekday FROM c_orders")
def c6(d: Data):
    return d["orders"].select("order_id", dates.iso_weekday(F.col(_P)).alias("weekday"))


@query(
    "c7_hour_month_year",
    """SELECT order_id, CAST(hour(order_approved_at) AS INTEGER) AS hour, CAST(month(order_approved_at) AS INTEGER) AS month,
       CAST(year(order_approved_at) AS INTEGER) AS year FROM c_orders""",
)
def c7(d: Data):
    at = "order_approved_at"
    return d["orders"].select("order_id", F.hour(at).alias("hour"), F.month(at).alias("month"), F.year(at).alias("year"))


@query(
    "c8_delay_label",
    f"SELECT order_id, CASE WHEN {days(_E, _D)} < 0 THEN 'Delay' ELSE 'No Delay' END AS delay FROM c_orders",
)
def c8(d: Data):
    early = dates.whole_days(F.col(_E), F.col(_D))
    return d["orders"].select("order_id", labels.delay_label(early).alias("delay"))


@query("c9_review_lag_label", f"WITH {_RD} SELECT review_id, {review_lag(days('review_creation_date', _D))} AS lag FROM rd")
def c9(d: Data):
    lag = dates.whole_days(F.col("review_creation_date"), F.col(_D))
    return _reviews_with_delivery(d).select("review_id", labels.review_lag_label(lag).alias("lag"))


@query(
    "c10_answer_lag_label",
    f"SELECT review_id, {answer_lag(days('review_answer_timestamp', 'review_creation_date'))} AS lag FROM c_reviews",
)
def c10(d: Data):
    lag = dates.whole_days(F.col("review_answer_timestamp"), F.col("review_creation_date"))
    return d["order_reviews"].select("review_id", labels.answer_lag_label(lag).alias("lag"))


@query(
    "c11_day_third",
    """WITH h AS (SELECT order_id, hour(order_approved_at) AS h FROM c_orders)
       SELECT order_id, CASE WHEN h < 8 THEN 1 WHEN h < 18 THEN 2 ELSE 3 END AS part FROM h""",
)
def c11(d: Data):
    return d["orders"].select("order_id", dates.day_third(F.hour("order_approved_at")).alias("part"))


@query(
    "c12_day_quarter",
    """WITH h AS (SELECT order_id, hour(order_approved_at) AS h FROM c_orders)
       SELECT order_id, CASE WHEN h BETWEEN 6 AND 11 THEN 2 WHEN h BETWEEN 12 AND 17 THEN 3 WHEN h BETWEEN 18 AND 22 THEN 4 ELSE 1 END AS part FROM h""",
)
def c12(d: Data):
    return d["orders"].select("order_id", dates.day_quarter(F.hour("order_approved_at")).alias("part"))


REGIONS = {
    "southern": [f"NATION_{i}" for i in range(0, 5)],
    "southeastern": [f"NATION_{i}" for i in range(5, 10)],
    "centralwestern": [f"NATION_{i}" for i in range(10, 15)],
    "northeastern": [f"NATION_{i}" for i in range(15, 20)],
}
REGION_SQL = (
    "CASE "
    + " ".join(f"WHEN customer_state IN ({', '.join(repr(s) for s in states)}) THEN '{r}'" for r, states in REGIONS.items())
    + " ELSE 'northern' END"
)


@query("c13_state_region", f"SELECT customer_id, customer_state, {REGION_SQL} AS region FROM c_customers")
def c13(d: Data):
    return d["customers"].select(
        "customer_id", "customer_state", labels.region_of(F.col("customer_state"), REGIONS).alias("region")
    )


@query(
    "c14_late_flag",
    f"SELECT order_id, CASE WHEN {_D} > {_E} THEN 1 ELSE 0 END AS late_deliveries FROM c_orders",
)
def c14(d: Data):
    return d["orders"].select("order_id", labels.late_flag(F.col(_D), F.col(_E)).alias("late_deliveries"))


@query(
    "c15_churn_flag",
    f"""WITH r AS (SELECT order_id, {days(f'(SELECT max({_P}) FROM c_orders)', _P)} AS recency FROM c_orders)
        SELECT order_id, recency, CASE WHEN recency > 180 THEN 1 ELSE 0 END AS churn,
               CASE WHEN recency > 180 THEN '1' ELSE '0' END AS churn_text FROM r""",
)
def c15(d: Data):
    latest = d["orders"].agg(F.max(_P)).scalar()
    aged = d["orders"].select("order_id", dates.whole_days(latest, F.col(_P)).alias("recency"))
    flag = labels.churn_flag(F.col("recency"))
    return aged.withColumns({"churn": flag, "churn_text": flag.cast("string")})


@query(
    "c16_location_key",
    """SELECT DISTINCT CAST(geolocation_lng AS VARCHAR) || CAST(geolocation_lat AS VARCHAR) AS lon_lat,
       CAST(geolocation_lng AS VARCHAR) || '_' || CAST(geolocation_lat AS VARCHAR) AS location_id FROM c_geolocation""",
)
def c16(d: Data):
    lng, lat = F.col("geolocation_lng"), F.col("geolocation_lat")
    return (
        d["geolocation"]
        .select(text.location_key(lng, lat).alias("lon_lat"), text.location_key(lng, lat, "_").alias("location_id"))
        .distinct()
    )


_NAME = """upper(regexp_replace(product_category_name, '\\s+', '', 'g')) || '_' ||
    CASE WHEN regexp_replace({id}, '[^0-9]', '', 'g') = '' THEN NULL
         WHEN ltrim(regexp_replace({id}, '[^0-9]', '', 'g'), '0') = '' THEN '0'
         ELSE ltrim(regexp_replace({id}, '[^0-9]', '', 'g'), '0') END"""


@query("c17_product_name", f"SELECT product_id, {_NAME.format(id='md5(CAST(product_id AS VARCHAR))')} AS product_name FROM c_products")
def c17(d: Data):
    hashed = F.md5(F.col("product_id").cast("string"))
    return d["products"].select("product_id", text.product_name(F.col("product_category_name"), hashed).alias("product_name"))


@query(
    "c18_log_features",
    """SELECT customer_unique_id, round(ln(1 + (ln(1 + (recency + 1)) + 1)), 9) AS recency,
       round(ln(1 + ln(1 + frequency)), 9) AS frequency, round(ln(1 + ln(1 + monetary_value)), 9) AS monetary_value FROM frows""",
)
def c18(d: Data):
    rows = d.facts.rows().select("customer_unique_id", "recency", "frequency", "monetary_value")
    return rounded(rfm.log_features(rows), 9, "recency", "frequency", "monetary_value")


@query(
    "c19_recency_segments",
    """SELECT CASE WHEN recency >= -1 AND recency < 60 THEN 'Recent' WHEN recency < 120 THEN 'Moderately Recent'
                   WHEN recency < 220 THEN 'Not So Recent' ELSE 'Inactive' END AS recency_segment, count(*) AS n
       FROM frows GROUP BY 1""",
)
def c19(d: Data):
    return rfm.recency_segments(d.facts.counted_rows).groupBy("recency_segment").agg(F.sum("n_rows").alias("n"))


@query(
    "c20_monetary_segments",
    """WITH p AS (SELECT customer_unique_id, monetary_value / 10000 AS monetary_value FROM frows),
       l AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
             (SELECT quantile_cont(monetary_value, 0.25) AS q1, quantile_cont(monetary_value, 0.75) AS q3 FROM p)),
       k AS (SELECT CASE WHEN monetary_value >= lo AND monetary_value <= hi THEN monetary_value END AS v FROM p, l)
       SELECT CASE WHEN v > 0 AND v <= 50 THEN 'Low' WHEN v > 50 AND v <= 150 THEN 'Medium' WHEN v > 150 AND v <= 300 THEN 'High'
                   WHEN v > 300 AND v <= 600 THEN 'Very High' END AS monetary_segment, count(*) AS n FROM k GROUP BY 1""",
)
def c20(d: Data):
    # the supplied amounts are in the hundred thousands; scaled to the published edges
    rows = d.facts.counted_rows.withColumn("monetary_value", F.col("monetary_value") / 10000)
    return rfm.monetary_segments(rows).groupBy("monetary_segment").agg(F.sum("n_rows").alias("n"))


@query(
    "c21_late_segments",
    """WITH l AS (SELECT customer_id, sum(late_deliveries) AS n FROM frows GROUP BY customer_id)
       SELECT CASE WHEN n <= 0 THEN 'No Late Deliveries' WHEN n <= 3 THEN 'Low' ELSE 'High' END AS late_delivery_segment, count(*) AS n
       FROM l GROUP BY 1""",
)
def c21(d: Data):
    from cartlens.plans.features import late_per_customer

    return rfm.late_segment_counts(late_per_customer(d.facts))


@query("c22_rfm_segments", "SELECT DISTINCT rfm_score, segment FROM scored")
def c22(d: Data):
    return rfm.rfm_scores(d.facts).select("rfm_score", "segment").distinct()


@query(
    "c23_percent_share",
    """WITH g AS (SELECT payment_type, count(*) AS n FROM c_payments GROUP BY 1)
       SELECT payment_type, n, round(100.0::DOUBLE * n / (SELECT sum(n) FROM g), 2) AS share FROM g""",
)
def c23(d: Data):
    return agg.frequencies(d["order_payments"], "payment_type", digits=2)


@query(
    "c24_label_codes",
    """SELECT order_id, payment_type, CAST(dense_rank() OVER (ORDER BY payment_type) - 1 AS INTEGER) AS payment_code FROM c_payments""",
)
def c24(d: Data):
    from cartlens.models.churn import label_codes

    payments = d["order_payments"].select("order_id", "payment_type")
    return label_codes(payments, {"payment_type": "payment_code"})


@query(
    "c25_first_seen_numbers",
    """WITH f AS (SELECT customer_unique_id, min(order_purchase_timestamp) AS t FROM c_orders JOIN c_customers USING (customer_id) GROUP BY 1)
       SELECT customer_unique_id, row_number() OVER (ORDER BY t, customer_unique_id) AS number FROM f""",
)
def c25(d: Data):
    seen = d["orders"].join(d["customers"], "customer_id").select("customer_unique_id", "order_purchase_timestamp")
    return ordered.first_seen_numbers(seen, "customer_unique_id", ["order_purchase_timestamp"], "number")


@query(
    "c25_lasting_numbers",
    """WITH f AS (SELECT customer_unique_id, min(order_purchase_timestamp) AS t,
              bool_or(order_purchase_timestamp < TIMESTAMP '1996-01-01') AS early FROM c_orders JOIN c_customers USING (customer_id) GROUP BY 1),
            a AS (SELECT customer_unique_id, row_number() OVER (ORDER BY t, customer_unique_id) AS number FROM f WHERE early),
            b AS (SELECT customer_unique_id, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY t, customer_unique_id) AS number FROM f WHERE NOT early)
       SELECT * FROM a UNION ALL SELECT * FROM b""",
)
def c25_lasting(d: Data):
    """Numbers of persons given in two runs, the second over all orders: the first run's numbers stay."""
    path = scratch_path(d.spark, "person-numbers")
    seen = d["orders"].join(d["customers"], "customer_id").select("customer_unique_id", "order_purchase_timestamp")
    ordered.lasting_numbers(seen.filter("order_purchase_timestamp < timestamp'1996-01-01'"), "customer_unique_id", ["order_purchase_timestamp"], "number", path)
    return ordered.lasting_numbers(seen, "customer_unique_id", ["order_purchase_timestamp"], "number", path)


@query(
    "c26_standardise",
    """SELECT order_id, product_id, round((price - (SELECT avg(price) FROM c_items)) / (SELECT stddev_pop(price) FROM c_items), 6) AS price,
       round((freight_value - (SELECT avg(freight_value) FROM c_items)) / (SELECT stddev_pop(freight_value) FROM c_items), 6) AS freight_value
       FROM c_items""",
)
def c26(d: Data):
    items = d["order_items"].select("order_id", "product_id", "price", "freight_value")
    return rounded(profile.standardise(items, ["price", "freight_value"]), 6, "price", "freight_value")


@query(
    "c27_threshold_label",
    "SELECT order_id, product_id, CASE WHEN freight_value / price < 0.04 THEN 0 ELSE 1 END AS label FROM c_items",
)
def c27(d: Data):
    rate = F.col("freight_value") / F.col("price")
    return d["order_items"].select("order_id", "product_id", labels.threshold_label(rate, 0.04).alias("label"))


@query(
    "c28_json_decode_encode",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS encoded
       FROM events""",
)
def c28(d: Data):
    events = d.raw("events")
    return events.select(
        "event_id",
        F.from_json("props", "k bigint")["k"].alias("k"),
        F.to_json(F.struct("event_id", "event_type")).alias("encoded"),
    )
