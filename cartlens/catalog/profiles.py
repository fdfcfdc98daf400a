"""Column profiles and tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartlens.catalog.registry import Data, query, rounded
from cartlens.functions import dates
from cartlens.functions import distributions as dist
from cartlens.operators import aggregates as agg
from cartlens.operators import profile, quantiles, stattests
from cartlens.plans.explore import with_time_of_day
from cartlens.session import materialize

_STATS = ("mean", "std", "min", "q25", "median", "q75", "max")


def _profile_sql(c: str, source: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({x}), 4) AS mean, round(stddev_samp({x}), 4) AS std, round(min({x}), 4) AS min,
        round(quantile_cont({x}, 0.25), 4) AS q25, round(median({x}), 4) AS median, round(quantile_cont({x}, 0.75), 4) AS q75, round(max({x}), 4) AS max FROM {source}"""


_NUMERIC = ("price", "freight_value", "payment_value", "payment_installments", "review_score", "product_weight_g", "product_photos_qty")


@query("e11_numeric_profile", " UNION ALL ".join(_profile_sql(c, "raw_wide") for c in _NUMERIC))
def e11(d: Data):
    rows = materialize(d.raw_wide.select(*_NUMERIC), "numbers")  # scanned twice
    return rounded(profile.numeric_profile(rows, _NUMERIC), 4, *_STATS)


_FEATURES = ("recency", "frequency", "customer_tenure", "num_orders")


@query("e11_feature_profile", " UNION ALL ".join(_profile_sql(c, "frows") for c in _FEATURES))
def e11b(d: Data):
    return rounded(profile.numeric_profile(d.facts.counted_rows, _FEATURES, "n_rows"), 4, *_STATS)


_TEXT = ("order_status", "payment_type", "customer_city", "product_category_name_english", "review_comment_title")


@query(
    "e12_text_profile",
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS "column", CAST(sum(n) OVER () AS BIGINT) AS count, count(*) OVER () AS "unique", {c} AS top, n AS freq
            FROM (SELECT {c}, count(*) AS n FROM raw_wide WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, {c} LIMIT 1)"""
        for c in _TEXT
    ),
)
def e12(d: Data):
    return profile.text_profile(d.raw_wide.select(*_TEXT), _TEXT)


def _quantile_sql(columns, probabilities, source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(CAST({p} AS DOUBLE), 6) AS probability, round(quantile_cont(CAST({c} AS DOUBLE), {p}), 4) AS value FROM {source}"""
        for c in columns
        for p in probabilities
    )


@query("e13_quantiles", _quantile_sql(_NUMERIC, (0.25, 0.75), "raw_wide"))
def e13(d: Data):
    rows = materialize(d.raw_wide.select(*_NUMERIC), "numbers")
    return rounded(quantiles.quantile_frame(rows, _NUMERIC, (0.25, 0.75)), {"value": 4, "probability": 6})


@query("e13_quantiles_by_counting", _quantile_sql(("price", "payment_value"), (0.05, 0.25, 0.5, 0.9), "raw_wide"))
def e13b(d: Data):
    """The way taken for columns with many distinct values, whatever their number."""
    columns, probabilities = ("price", "payment_value"), (0.05, 0.25, 0.5, 0.9)
    q = quantiles.exact_quantiles(materialize(d.raw_wide.select(*columns), "numbers"), columns, probabilities, final_limit=64)
    rows = [(c, p, v) for c in columns for p, v in zip(probabilities, q[c])]
    frame = d.spark.createDataFrame(rows, "`column` string, probability double, value double")
    return rounded(frame, {"value": 4, "probability": 6})


_SHAPED = ("price", "freight_value", "payment_value", "product_weight_g")


def _shape_sql(c: str, source: str, value: str | None = None) -> str:
    x = f"CAST({value or c} AS DOUBLE)"
    return f"""SELECT '{c}' AS "column", count({x}) AS count,
        round(skewness({x}) * (count({x}) - 2) / sqrt(count({x})::DOUBLE * (count({x}) - 1)), 6) AS skew,
        round(skewness({x}), 6) AS adjusted_skew, round(kurtosis_pop({x}), 6) AS kurtosis FROM {source}"""


@query("e14_skew_and_kurtosis", " UNION ALL ".join(_shape_sql(c, "raw_wide") for c in _SHAPED))
def e14(d: Data):
    return rounded(profile.shape_profile(d.raw_wide.select(*_SHAPED), _SHAPED), 6, "skew", "adjusted_skew", "kurtosis")


@query(
    "e14_shape_inside_fence",
    " UNION ALL ".join(
        _shape_sql(
            c,
            f"""(SELECT CASE WHEN {c} > q[1] - 1.5 * (q[2] - q[1]) AND {c} < q[2] + 1.5 * (q[2] - q[1]) THEN {c} END AS v FROM raw_wide,
                (SELECT quantile_cont({c}, [0.25, 0.75]) AS q FROM raw_wide))""",
            "v",
        )
        for c in _SHAPED
    ),
)
def e14b(d: Data):
    return rounded(profile.shape_inside_fence(materialize(d.raw_wide.select(*_SHAPED), "numbers"), _SHAPED), 6, "skew", "adjusted_skew", "kurtosis")


@query(
    "e15_near_normal",
    "SELECT \"column\", skew, kurtosis, CASE WHEN abs(skew) < 2 AND abs(kurtosis) < 2 THEN 'normal' ELSE 'not normal' END AS distribution FROM ("
    + " UNION ALL ".join(_shape_sql(c, "raw_wide") for c in _SHAPED)
    + ")",
)
def e15(d: Data):
    return rounded(profile.near_normal(d.raw_wide.select(*_SHAPED), _SHAPED), 6, "skew", "kurtosis")


@query(
    "e30_histogram",
    """WITH b AS (SELECT min(price) AS lo, (max(price) - min(price)) / 30.0::DOUBLE AS w FROM c_items),
       g AS (SELECT CAST(least(floor((price - lo) / w), 29) AS INTEGER) AS bin, count(*) AS n, any_value(lo) AS lo, any_value(w) AS w FROM c_items, b GROUP BY 1)
       SELECT bin, round(lo + bin * w, 4) AS bin_start, round(lo + (bin + 1) * w, 4) AS bin_end, n FROM g""",
)
def e30(d: Data):
    return rounded(profile.histogram(d["order_items"], "price", 30), 4, "bin_start", "bin_end")


@query(
    "e30_histogram_between_limits",
    """SELECT CAST(least(floor((price - 0.0::DOUBLE) / 37.5::DOUBLE), 19) AS INTEGER) AS bin, count(*) AS n FROM c_items
       WHERE price >= 0 AND price <= 750 GROUP BY 1 UNION ALL
       SELECT CAST(100 + least(floor((price - 1000.0::DOUBLE) / 1000.0::DOUBLE), 4) AS INTEGER), count(*) FROM c_items WHERE price >= 1000 AND price <= 6000 GROUP BY 1""",
)
def e30b(d: Data):
    low = profile.histogram(d["order_items"], "price", 20, 0, 750).select("bin", "n")
    mid = profile.histogram(d["order_items"], "price", 5, 1000, 6000)
    return low.unionByName(mid.select((F.col("bin") + 100).alias("bin"), "n"))


@query(
    "e31_density_curve",
    """WITH m AS (SELECT count(freight_value) AS n, min(freight_value) AS lo, max(freight_value) AS hi,
              stddev_samp(freight_value) * pow(count(freight_value), -0.2) AS h FROM c_items),
       g AS (SELECT lo + (hi - lo) / 49 * i AS x, n, h FROM m, range(0, 50) r(i)),
       v AS (SELECT freight_value AS v, count(*) AS c FROM c_items GROUP BY 1)
       SELECT round(x, 4) AS x, round(1e6 * sum(c * exp(-0.5 * pow((v - x) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 5) AS density_e6
       FROM g, v GROUP BY x""",
)
def e31(d: Data):
    curve = profile.density_curve(d["order_items"], "freight_value", 50)
    return curve.select(F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 5).alias("density_e6"))


@query(
    "e32_letter_values",
    _quantile_sql(("price", "product_weight_g"), ("0.0", "(1.0/16)", "0.125", "0.25", "0.5", "0.75", "0.875", "(15.0/16)", "1.0"), "raw_wide"),
)
def e32(d: Data):
    columns = ("price", "product_weight_g")
    return rounded(profile.letter_values(materialize(d.raw_wide.select(*columns), "numbers"), columns), {"value": 4, "probability": 6})


# -- tests ---------------------------------------------------------------------------------

_HALVES = "h AS (SELECT *, CASE WHEN order_item_id <= 3 THEN 'a' ELSE 'b' END AS side FROM c_items)"


def _t_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, round((ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb)), 6) AS t_statistic,
        CAST(na + nb - 2 AS BIGINT) AS degrees FROM (SELECT
        CAST(count({c}) FILTER (WHERE side = 'a') AS DOUBLE) AS na, avg({c}) FILTER (WHERE side = 'a') AS ma, var_samp({c}) FILTER (WHERE side = 'a') AS va,
        CAST(count({c}) FILTER (WHERE side = 'b') AS DOUBLE) AS nb, avg({c}) FILTER (WHERE side = 'b') AS mb, var_samp({c}) FILTER (WHERE side = 'b') AS vb FROM h)"""


def _halves(d: Data):
    return d["order_items"].withColumn("side", F.when(F.col("order_item_id") <= 3, "a").otherwise("b"))


@query("s2_two_sample_t", f"WITH {_HALVES} {_t_sql('price')} UNION ALL {_t_sql('freight_value')}")
def s2(d: Data):
    return rounded(stattests.two_sample_t(_halves(d), "side", ["price", "freight_value"], "a", "b"), 6, "t_statistic")


# the two-sided p-value from Simpson's rule over the density
_T_P = """1 - 2 * abs(t_statistic) / 2000 / 3 * exp(lgamma((degrees + 1) / 2.0) - lgamma(degrees / 2.0)) / sqrt(degrees * pi())
    * (SELECT sum(CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
       * exp(-(degrees + 1) / 2.0 * ln(1 + t_statistic * t_statistic * k * k / 4e6 / degrees))) FROM range(2001) AS r(k))"""


@query(
    "s2_two_sample_t_with_p_values",
    f"""WITH {_HALVES} SELECT * REPLACE (round(p_value, 5) AS p_value), p_value < 0.05 AS differs
        FROM (SELECT *, {_T_P} AS p_value FROM ({_t_sql('price')} UNION ALL {_t_sql('freight_value')}))""",
)
def s2b(d: Data):
    tests = stattests.with_t_p_value(stattests.two_sample_t(_halves(d), "side", ["price", "freight_value"], "a", "b"))
    return rounded(tests.withColumn("differs", F.col("p_value") < 0.05), {"t_statistic": 6, "p_value": 5})


@query(
    "s3_chi_square_uniform",
    """WITH g AS (SELECT CASE WHEN hour(order_approved_at) < 8 THEN 1 WHEN hour(order_approved_at) < 18 THEN 2 ELSE 3 END AS part, count(*) AS n FROM c_orders GROUP BY 1),
       e AS (SELECT sum(n) / count(*) AS e, count(*) AS k FROM g)
       SELECT round(sum((n - e) * (n - e) / e), 6) AS statistic, CAST(any_value(k) - 1 AS BIGINT) AS degrees FROM g, e""",
)
def s3(d: Data):
    parts = agg.counts(with_time_of_day(d["orders"], "order_approved_at"), "time_of_day")
    return rounded(stattests.chi_square_uniform(parts), 6, "statistic")


# chi-square with an even number of degrees has a closed form
@query(
    "s3_chi_square_with_p_value",
    """WITH g AS (SELECT isodow(order_purchase_timestamp) AS day, count(*) AS n FROM c_orders GROUP BY 1),
       e AS (SELECT sum(n) / count(*) AS e, count(*) AS k FROM g),
       s AS (SELECT sum((n - e) * (n - e) / e) AS s, CAST(any_value(k) - 1 AS BIGINT) AS degrees FROM g, e)
       SELECT round(s, 6) AS statistic, degrees, round(exp(-s / 2) * (1 + s / 2 + s * s / 8), 8) AS p_value, s > 12.591587 AS uneven FROM s""",
)
def s3b(d: Data):
    parts = agg.counts(d["orders"].select(dates.iso_weekday(F.col("order_purchase_timestamp")).alias("day")), "day")
    tested = stattests.with_chi2_p_value(stattests.chi_square_uniform(parts))
    return rounded(tested.withColumn("uneven", F.col("p_value") < 0.05), {"statistic": 6, "p_value": 8})


@query(
    "s4_chi_square_independence",
    """WITH o AS (SELECT order_status, payment_type, CAST(count(*) AS DOUBLE) AS o FROM c_orders JOIN c_payments USING (order_id) GROUP BY ALL),
       g AS (SELECT r.order_status, c.payment_type, r.t * c.t / (SELECT sum(o) FROM o) AS e
             FROM (SELECT order_status, sum(o) AS t FROM o GROUP BY 1) r, (SELECT payment_type, sum(o) AS t FROM o GROUP BY 1) c)
       SELECT round(sum((coalesce(o, 0) - e) * (coalesce(o, 0) - e) / e), 6) AS statistic,
              CAST((count(DISTINCT order_status) - 1) * (count(DISTINCT payment_type) - 1) AS BIGINT) AS degrees
       FROM g LEFT JOIN o USING (order_status, payment_type)""",
)
def s4(d: Data):
    paid = d["orders"].select("order_id", "order_status").join(d["order_payments"], "order_id")
    return rounded(stattests.chi_square_independence(paid, "order_status", "payment_type"), 6, "statistic")


def _normality_sql(source: str, value: str | None = None) -> str:
    """Jarque-Bera from the shape figures; the p-value is the tail of chi-square with two degrees."""

    def one(c: str) -> str:
        x = f"CAST({value or c} AS DOUBLE)"
        g = f"(skewness({x}) * (count({x}) - 2) / sqrt(count({x})::DOUBLE * (count({x}) - 1)))"
        k = f"kurtosis_pop({x})"
        return f"SELECT '{c}' AS \"column\", count({x}) / 6.0::DOUBLE * ({g} * {g} + {k} * {k} / 4) AS s FROM {source.format(c=c)}"

    both = " UNION ALL ".join(one(c) for c in ("price", "freight_value"))
    return f"""SELECT "column", round(s, 4) AS statistic, round(exp(s / -2), 6) AS p_value, CAST(exp(s / -2) > 0.05 AS INTEGER) AS is_normal
        FROM ({both})"""


@query("s5_normality", _normality_sql("c_items"))
def s5(d: Data):
    tested = stattests.normality(d["order_items"], ["price", "freight_value"])
    return rounded(tested, {"statistic": 4, "p_value": 6})


_FENCED = """(SELECT CASE WHEN {c} > q[1] - 1.5 * (q[2] - q[1]) AND {c} < q[2] + 1.5 * (q[2] - q[1]) THEN {c} END AS v FROM c_items,
    (SELECT quantile_cont({c}, [0.25, 0.75]) AS q FROM c_items))"""


@query("s5_normality_inside_fence", _normality_sql(_FENCED, "v"))
def s5b(d: Data):
    columns = ["price", "freight_value"]
    tested = stattests.normality(profile.fenced(d["order_items"].select(*columns), columns), columns)
    return rounded(tested, {"statistic": 4, "p_value": 6})


def _quantile_sql(p: str) -> str:
    """The normal quantile, with the same fixed values."""

    def poly(x: str, factors) -> str:
        out = f"{factors[0]!r}::DOUBLE"
        for c in factors[1:]:
            out = f"({out} * {x} + {c!r}::DOUBLE)"
        return out

    t = f"sqrt(-2 * ln(least({p}, 1 - {p})))"
    q = f"({p} - 0.5)"
    tail = f"{poly(t, dist.TAIL_TOP)} / {poly(t, dist.TAIL_BOTTOM)}"
    centre = f"{q} * {poly(f'({q} * {q})', dist.CENTRE_TOP)} / {poly(f'({q} * {q})', dist.CENTRE_BOTTOM)}"
    return f"CASE WHEN {p} < {dist.TAIL} THEN {tail} WHEN {p} > 1 - {dist.TAIL} THEN -{tail} ELSE {centre} END"


def _rank_sql(source: str, value: str | None = None) -> str:
    """Shapiro-Francia row by row: every value with the score of its rank."""
    both = " UNION ALL ".join(
        f"SELECT '{c}' AS c, CAST({value or c} AS DOUBLE) AS x FROM {source.format(c=c)}" for c in ("price", "freight_value")
    )
    return f"""WITH v AS ({both}), r AS (SELECT c, x, avg(x) OVER (PARTITION BY c) AS mean, count(*) OVER (PARTITION BY c) AS n,
        (row_number() OVER (PARTITION BY c ORDER BY x) - 0.375::DOUBLE) AS i FROM v WHERE x IS NOT NULL),
        p AS (SELECT c, n, x - mean AS d, i / (n + 0.25::DOUBLE) AS p FROM r), m AS (SELECT c, n, d, {_quantile_sql('p')} AS m FROM p),
        w AS (SELECT c, n, sum(m * d) * sum(m * d) / (sum(m * m) * sum(d * d)) AS w FROM m GROUP BY c, n),
        z AS (SELECT c, n, w, (ln(1 - w) + 1.2725 - 1.0521 * (ln(ln(n)) - ln(n))) / (1.0308 - 0.26758 * (ln(ln(n)) + 2 / ln(n))) AS z FROM w)
        SELECT c AS "column", n, round(w, 7) AS statistic, round(z, 4) AS z, CAST(z < 1.6448536269514722 AS INTEGER) AS is_normal FROM z"""


@query("s5_rank_normality", _rank_sql("c_items"))
def s5_ranks(d: Data):
    tested = stattests.rank_normality(d["order_items"], ["price", "freight_value"]).drop("p_value")
    return rounded(tested, {"statistic": 7, "z": 4})


@query("s5_rank_normality_inside_fence", _rank_sql(_FENCED, "v"))
def s5_ranks_inside(d: Data):
    columns = ["price", "freight_value"]
    tested = stattests.rank_normality(profile.fenced(d["order_items"].select(*columns), columns), columns).drop("p_value")
    return rounded(tested, {"statistic": 7, "z": 4})
