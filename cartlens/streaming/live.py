"""Live figures over streams; every function also accepts a batch frame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartlens.operators import aggregates as agg
from cartlens.operators import clean
from cartlens.plans import kpis
from cartlens.plans.wide import dashboard_view
from cartlens.streaming import sinks


def sales_windows(sales: DataFrame, minutes: int = 60, slide: str = "1 minute", delay: str | None = None) -> DataFrame:
    """Transactions, orders and sales of every sliding window. delay is how late a sale may
    arrive on a stream; windows are final once it has passed."""
    if delay is not None:
        sales = sales.withWatermark("created_date", delay)
    windows = sales.groupBy(F.window("created_date", f"{minutes} minutes", slide).alias("w")).agg(
        F.count(F.lit(1)).alias("num_transactions"),
        agg.money_sum("salesamount").alias("sales"),
    )
    return windows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "num_transactions", "sales")


GROUP = ("created_date", "salesordernumber")


def grouped_sales(sales: DataFrame, delay: str) -> DataFrame:
    """Sales per timestamp and order, kept as state for `delay` behind the newest sale. In update mode a micro-batch
    gives the groups it changed, with all that has arrived for them."""
    return sales.withWatermark("created_date", delay).groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("num_transactions"), F.sum(agg.exact("salesamount")).alias("amount")
    )


def rolling_writer(path: str, periods: Sequence[int] = (60, 30, 10, 5)) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for grouped_sales in update mode: after every micro-batch the totals of the last minutes
    before the newest sale so far, as path/totals/batch_id=N.

    The groups of the longest period are kept in path/groups/batch_id=N: those of the micro-batch before, with
    changed ones replaced and too old ones left out. So neither they nor the state grow with the stream, and a
    micro-batch that is run again reads the same and overwrites its own.
    """

    def write(changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        groups = changed.select(*GROUP, "num_transactions", "amount")
        if batch_id:
            before = spark.read.parquet(f"{path}/groups/batch_id={batch_id - 1}")
            same = [before[c].eqNullSafe(groups[c]) for c in GROUP]
            groups = before.join(groups, same, "left_anti").unionByName(groups)
        newest = groups.agg(F.max("created_date")).scalar()
        recent = groups.filter(F.col("created_date") >= newest - F.make_dt_interval(mins=F.lit(max(periods))))
        target = f"{path}/groups/batch_id={batch_id}"
        recent.write.mode("overwrite").parquet(target)
        kept = spark.read.schema(groups.schema).parquet(target)
        sales = F.round(F.coalesce(F.col("amount").cast("double"), F.lit(0.0)), 2).cast("int")
        one = F.col("salesordernumber").isNotNull().cast("bigint")
        rows = kept.select("created_date", "num_transactions", one.alias("num_orders"), sales.alias("sales"))
        totals = kpis.totals_of_groups(rows, kept.agg(F.max("created_date")).scalar(), periods)
        totals.coalesce(1).write.mode("overwrite").parquet(f"{path}/totals/batch_id={batch_id}")

    return write


def rolling_totals(sales: DataFrame, path: str, periods: Sequence[int] = (60, 30, 10, 5), **kw) -> StreamingQuery:
    """Totals of the last minutes after every micro-batch. A sale that is late is counted wherever it still belongs:
    the state reaches back as far as the longest period."""
    groups = grouped_sales(sales, f"{max(periods)} minutes")
    return sinks.to_batches(groups, rolling_writer(path, periods), f"{path}/checkpoint", mode="update", **kw)


def selected_view(rows: DataFrame, seller_states: Sequence[str] | None, customer_states: Sequence[str] | None, cutoff: str) -> DataFrame:
    """Dashboard rows of the selected states."""
    lists = {}
    if seller_states:
        lists["seller_state"] = list(seller_states)
    if customer_states:
        lists["customer_state"] = list(customer_states)
    return dashboard_view(clean.in_lists(rows, lists), cutoff)


def geo_partials(seller_states=None, customer_states=None, cutoff: str = "2018-09"):
    """What one micro-batch adds to the live geography page: sums over all rows, and sums per order and city
    of the selected ones. Partials of any number of batches add up to the figures."""

    def totals(rows: DataFrame) -> DataFrame:
        return rows.agg(
            F.sum(agg.exact("freight_value")).alias("freight"), F.count("freight_value").alias("freights"),
            F.sum(agg.exact("payment_value")).alias("paid"),
            F.sum("review_score").cast("bigint").alias("score"), F.count("review_score").alias("scores"),
        )

    def places(rows: DataFrame) -> DataFrame:
        view = selected_view(rows, seller_states, customer_states, cutoff)
        sums = []
        for c in PLACE_DAYS.values():
            sums += [F.sum(c).alias(c), F.count(c).alias(f"{c}_n")]
        return view.groupBy("customer_state", "customer_city", "order_id").agg(*sums)

    return {"totals": totals, "places": places}


# The figures of the page and the day column each is the mean of.
PLACE_DAYS = {"fastest_cities": "difference_purchased_delivered", "most_delayed_cities": "estimated_delivered_difference"}


def geo_figures(totals: DataFrame, places: DataFrame, k: int = 5) -> dict[str, DataFrame]:
    """The four figures of the page from the partials of all micro-batches so far."""
    freight = F.sum("freight").cast("double")
    figures = {
        "totals": totals.agg(
            F.try_divide(freight, F.sum("freights")).alias("average_freight"),
            F.coalesce(F.sum("paid").cast("double"), F.lit(0.0)).alias("total_payment"),
            F.try_divide(F.sum("score").cast("double"), F.sum("scores")).alias("average_score"),
            F.coalesce(freight, F.lit(0.0)).alias("total_freight"),
        ),
        "orders_per_state": kpis.orders_per_state(places),
    }
    for name, c in PLACE_DAYS.items():
        mean = F.try_divide(F.sum(c).cast("double"), F.sum(f"{c}_n")).alias("mean_days")
        means = agg.keyed(places, ["customer_city"]).groupBy("customer_city").agg(mean)
        figures[name] = agg.top_k(means.filter(F.col("mean_days").isNotNull()), "mean_days", k, ["customer_city"], ascending=True)
    return figures
