from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lodework.operators import advance, features, governance, sinks
from lodework.operators.features import Spine
from tests.conftest import rows
from tests.test_features import FACTS, fact  # noqa: F401
from tests.test_governance import gates

START = date(1999, 12, 1)


def stepped(folder, start, first, following, until):
    """A stored state at the start, advanced to ``until`` day by day."""
    state, day = sinks.replace(first(start), f"{folder}/{start}"), start
    while day < until:
        day += timedelta(days=1)
        state = sinks.replace(following(state, day), f"{folder}/{day}")
    return state


# FACTS lie around these days: entering, leaving, the end of a month, of a year, and of February.
@pytest.mark.parametrize("start, until", [(START, date(1999, 12, 4)), (date(1999, 12, 30), date(2000, 1, 2))])
def test_customers_equal_the_full_build(spark, fact, folder, start, until):  # noqa: F811
    early, everyone = [spark.createDataFrame([(c,) for c in ids], "customer_id long") for ids in ((1, 2), (1, 2, 3, 4))]
    state = stepped(folder, start, lambda day: advance.rfm_state(fact, early, day),
                    lambda state, day: advance.rfm_next(state, fact, everyone, day), until)
    full = features.customer_rfm(fact, everyone, Spine(start - timedelta(days=700), until))
    month = features.customer_rfm(fact, everyone, Spine(until.replace(day=1), until))
    expected = rows(full.filter(F.col("observation_date") == F.lit(until)))
    assert rows(advance.rfm_on(state, until)) == expected == rows(month.filter(F.col("observation_date") == F.lit(until)))


@pytest.mark.parametrize("start, until", [(START, date(1999, 12, 3)), (date(1999, 12, 30), date(2000, 1, 1))])
def test_products_equal_the_full_build(spark, fact, folder, start, until):  # noqa: F811
    products = spark.createDataFrame([(1,), (2,), (3,), (4,)], "product_id long")
    state = stepped(folder, start, lambda day: advance.product_state(fact, products, day),
                    lambda state, day: advance.product_next(state, fact, products, day), until)
    full = features.product_performance(fact, products, Spine(start, until))
    assert rows(advance.products_on(state, until)) == rows(full.filter(F.col("observation_date") == F.lit(until)))


def test_a_day_reads_its_facts_and_those_that_leave(spark, fact, folder):  # noqa: F811
    stored = sinks.replace(fact, f"{folder}/fact")
    customers = spark.createDataFrame([(1,)], "customer_id long")
    state = sinks.replace(advance.rfm_state(stored, customers, START), f"{folder}/state")
    plan = advance.rfm_next(state, stored, customers, START + timedelta(days=1))._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "FileScan" in line and "date_key" in line]
    assert len(scan) == 1 and "1999-12-02" in scan[0] and "1998-12-01" in scan[0] and "Or(EqualTo(date_key" in scan[0]


def test_leaving_dates_equal_the_steps(spark):
    days = spark.range(1500).select(F.date_add(F.lit(date(1998, 1, 1)), F.col("id").cast("int")).alias("date_key"))
    told = days.withColumn("rfm", features.reaching(F.date_add("date_key", 1), 12)).withColumn("sold", features.reaching(F.col("date_key"), 12))
    for day in (date(1999, 2, 28), date(1999, 3, 1), date(2000, 2, 28), date(2000, 2, 29), date(2000, 3, 1), date(2001, 3, 1), date(2001, 2, 28)):
        rfm = (F.col("date_key") >= advance._back(day - timedelta(days=1), 12)) & (F.col("date_key") < advance._back(day, 12))
        sold = (F.col("date_key") > advance._back(day - timedelta(days=1), 12)) & (F.col("date_key") <= advance._back(day, 12))
        assert told.filter((F.col("rfm") == F.lit(day)) != rfm).count() == 0, day
        assert told.filter((F.col("sold") == F.lit(day)) != sold).count() == 0, day


def test_snapshots_by_stretches_equal_the_whole_series(spark, folder):
    values = {1: "aaabbbbbbccc", 2: "abababababab", 3: "  xxx  xy  y", 4: "         qqq", 5: "zz          "}
    series = spark.createDataFrame([(k, START + timedelta(days=i), v) for k, vs in values.items() for i, v in enumerate(vs) if v != " "],
                                   "k long, observation_date date, v string")
    store = features.SnapshotStore(spark, folder)
    told = lambda part: features.snapshots_from_series(part, "k", "thing", {"f": "v"})
    before = None
    for n, (first, last) in enumerate(((0, 3), (4, 4), (5, 9), (10, 11))):
        for _ in range(2):  # a stretch that runs again changes nothing
            store.feed(told(features.observed_between(series, START + timedelta(days=first), START + timedelta(days=last))), f"s{n}", before)
        before = f"s{n}"
    assert rows(store.read("s3")) == rows(told(series))
    assert rows(store.read("s1")) == rows(told(series.filter(F.col("observation_date") <= START + timedelta(days=4))))


def test_gate_runs_add_up(spark, folder):
    for status in ("PASS", "FAIL", "PASS"):
        history = governance.append_run(gates(spark, status), f"{folder}/gates")
    assert rows(governance.decisions(history), "run_id", "release_status", "fail_count") == [
        (1, "PASS", 0), (2, "FAIL", 1), (3, "PASS", 0)]
    latest = governance.latest_run(history)
    assert latest.count() == 11 and {r.run_id for r in latest.collect()} == {3}
    assert "Window" not in latest._jdf.queryExecution().executedPlan().toString()


def test_the_moving_facts_are_enough_for_their_days(spark, fact, folder):  # noqa: F811
    products = spark.createDataFrame([(1,), (2,)], "product_id long")
    first, last = date(1997, 2, 27), date(1997, 3, 1)
    moving = fact.filter(advance.moving(first, last))
    assert 0 < moving.count() < fact.count()
    before = advance.product_state(fact, products, first - timedelta(days=1))
    few = stepped(f"{folder}/few", first - timedelta(days=1), lambda day: before,
                  lambda state, day: advance.product_next(state, moving, products, day), last)
    assert rows(few) == rows(advance.product_state(fact, products, last))
