"""What lasts between runs and micro-batches: numbers of keys, and the last minutes of a stream."""

from datetime import datetime, timedelta

from conftest import rows

from cartlens.operators import ordered
from cartlens.plans import kpis
from cartlens.session import scratch_path
from cartlens.streaming import live

START = datetime(2024, 1, 1)
SALES = "created_date timestamp, salesordernumber string, salesamount double"


def frame(spark, data):
    return spark.createDataFrame(data, "k string, t int")


def test_numbers_last(spark):
    path = scratch_path(spark, "numbers")
    first = ordered.lasting_numbers(frame(spark, [("b", 1), ("a", 2), ("b", 9), (None, 5)]), "k", ["t"], "n", path)
    assert rows(first) == sorted([("b", 1), ("a", 2), (None, 3)], key=str)
    more = [("z", 0), ("a", 0), ("c", 3), ("b", 1), (None, 0)]
    second = {r["k"]: r["n"] for r in ordered.lasting_numbers(frame(spark, more), "k", ["t"], "n", path).collect()}
    assert second == {"b": 1, "a": 2, None: 3, "z": 4, "c": 5}
    again = ordered.lasting_numbers(frame(spark, more), "k", ["t"], "n", path)
    assert {r["k"]: r["n"] for r in again.collect()} == second and again.count() == 5
    assert ordered.lasting_numbers(frame(spark, []), "k", ["t"], "n", path).count() == 5


def test_many_runs_are_gapless(spark):
    path = scratch_path(spark, "numbers")
    for run in range(4):
        got = ordered.lasting_numbers(spark.range(0, 50 * (run + 1), 1 + run % 2).selectExpr("cast(id as string) as k", "cast(id as int) as t"), "k", ["t"], "n", path)
    numbers = sorted(r["n"] for r in got.collect())
    assert numbers == list(range(1, len(numbers) + 1))


def test_rolling_totals_after_every_batch(spark):
    minute = lambda m: START + timedelta(minutes=m)
    batches = [
        [(minute(1), "a", 1.0), (minute(3), "b", 2.504), (minute(3), "b", 0.3)],
        [(minute(40), "c", 3.999), (minute(2), "a", 5.0)],  # a late sale that still belongs to the last hour
        [(minute(59), "d", 7.0), (minute(3), "b", 0.2)],  # an order that grows
        [(minute(200), "e", 9.5)],  # everything before is too old
        [(minute(150), "f", 4.0), (minute(100), "g", 1000.0), (minute(200), None, 1.0)],  # late: in the hour, and before it
        [(minute(201), "h", None)],
    ]
    path = scratch_path(spark, "rolling")
    for n, data in enumerate(batches):
        spark.createDataFrame(data, SALES).coalesce(1).write.parquet(f"{path}/topic/{n}")
        stream = spark.readStream.schema(SALES).parquet(f"{path}/topic/*")
        live.rolling_totals(stream, f"{path}/out").awaitTermination()
        arrived = spark.read.schema(SALES).parquet(*[f"{path}/topic/{k}" for k in range(n + 1)])
        totals = spark.read.parquet(f"{path}/out/totals")
        last = totals.agg({"batch_id": "max"}).first()[0]
        assert rows(totals.filter(f"batch_id = {last}").drop("batch_id")) == rows(kpis.live_totals(arrived)), n
    kept = spark.read.parquet(f"{path}/out/groups/batch_id={last}")
    assert kept.filter(kept.created_date < minute(141)).count() == 0


def test_a_batch_that_runs_again_changes_nothing(spark):
    path = scratch_path(spark, "rolling")
    write = live.rolling_writer(path)
    changed = [
        spark.createDataFrame([(START, "a", 1, 1.5)], "created_date timestamp, salesordernumber string, num_transactions bigint, amount double"),
        spark.createDataFrame([(START, "a", 2, 2.5), (START + timedelta(minutes=1), "b", 1, 4.0)],
                              "created_date timestamp, salesordernumber string, num_transactions bigint, amount double"),
    ]
    write(changed[0], 0)
    write(changed[1], 1)
    once = rows(spark.read.parquet(f"{path}/totals/batch_id=1"))
    write(changed[1], 1)
    assert rows(spark.read.parquet(f"{path}/totals/batch_id=1")) == once
    assert {r[0]: r[1:] for r in once} == {m: (3, 2, 6) for m in (60, 30, 10, 5)}
