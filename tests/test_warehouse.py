import datetime as dt
import os
from decimal import Decimal as D

from pyspark.sql import functions as F

from conftest import SF_SMALL, make_fleet
from convoy.plans import batches as B
from convoy.plans import warehouse as W
from convoy.sources.fleet import cached_fleet

T = dt.datetime
S = T(2001, 7, 31, 10)


def _fleet(spark, deliveries):
    return make_fleet(
        spark,
        vehicles=[(1, "V1", "Van", D("1500"), "diesel", dt.date(1995, 1, 1), "active")],
        drivers=[(1, "E1", "Ana", "Diaz", "L1", dt.date(2002, 1, 1), "300", dt.date(1995, 1, 1), "active")],
        routes=[(1, "R1", "A", "B", D("100.00"), D("2.00"), D("15000.00"))],
        trips=[(1, 1, 1, 1, T(2001, 7, 31, 8), T(2001, 7, 31, 12), D("20.00"), D("100.00"), "completed"),
               (2, 1, 1, 1, T(2001, 7, 31, 8), T(2001, 7, 31, 8), D("20.00"), D("100.00"), "completed")],
        deliveries=deliveries)


def _d(i, kg, minutes, trip=1):
    delivered = None if minutes is None else S + dt.timedelta(minutes=minutes)
    return (i, trip, f"FL{i}", f"C{i}", "Calle 1, B", D(kg), S, delivered,
            "delivered" if delivered else "pending", True)


def test_quality_filters_and_measures(spark):
    rows = [_d(1, "0.00", 0), _d(2, "0.01", 0), _d(3, "9999.99", 30), _d(4, "10000.00", 0),
            _d(5, "1.00", -1), _d(6, "1.00", 31), _d(7, "1.00", None), _d(8, "1.00", 120, trip=2)]
    f = _fleet(spark, rows)
    acc, rej = W.measures(W.extract(f, last_day=False))
    accepted = {r.delivery_id: r for r in acc.collect()}
    assert sorted(accepted) == [2, 3, 6, 8]
    assert {r.delivery_id: r.reject_reason for r in rej.collect()} == {
        1: "package_weight", 4: "package_weight", 5: "delivery_time", 7: "delivery_time"}
    assert accepted[3].is_on_time and not accepted[6].is_on_time    # 30 min on time, 31 late
    assert accepted[6].delay_minutes == 31.0
    # trip 1 has 7 extracted deliveries over 4 hours (counted before the filters)
    assert accepted[2].deliveries_per_hour == 1.75
    assert accepted[2].cost_per_delivery == round((20 * 5000 + 15000) / 7, 2)
    assert accepted[2].fuel_efficiency_km_per_liter == 5.0
    assert accepted[8].deliveries_per_hour is None                    # zero-length trip
    assert accepted[3].revenue_per_delivery == 20000 + 9999.99 * 500


def test_extract_window_excludes_newest(spark):
    f = _fleet(spark, [_d(1, "1.00", 0), _d(2, "1.00", 60), _d(3, "1.00", -24 * 60 - 1)])
    ids = sorted(r.delivery_id for r in W.extract(f).collect())
    assert ids == [1]


def test_daily_totals_empty_day_gives_one_row(spark):
    f = _fleet(spark, [_d(2, "1.00", 0)])
    facts = W.fact_rows(W.measures(W.extract(f, last_day=False))[0])
    keys = {"delivery": "delivery_id", "vehicle": "vehicle_id", "driver": "driver_id",
            "route": "route_id", "customer": "customer_name"}
    (row,) = W.daily_totals(facts, date_key=20000101, keys=keys).collect()
    assert row.total_deliveries == 0 and row.total_package_weight_kg is None
    (row,) = W.daily_totals(facts, date_key=20010731, keys=keys).collect()
    assert row.total_deliveries == 1 and row.on_time_porcentaje == D("100.00")


def test_run_daily_is_rerun_safe(spark, tmp_dir):
    fleet = cached_fleet(spark, SF_SMALL)
    out = os.path.join(tmp_dir, "wh")
    m1 = B.run_daily(spark, fleet, out, "2001-08-01 00:00:00", batch_id=1)
    facts1 = B.stored(spark, out)["fact_deliveries"].drop("etl_timestamp")
    n1 = facts1.count()
    assert m1["records_loaded"] == n1 > 0 and m1["errors"] == 0
    B.run_daily(spark, fleet, out, "2001-08-01 00:00:00", batch_id=1)
    t = B.stored(spark, out)
    facts2 = t["fact_deliveries"].drop("etl_timestamp")
    assert sorted(facts2.collect()) == sorted(facts1.collect()) and facts2.count() == n1
    assert t["dim_driver"].where("is_current").groupBy("driver_id").count().where("count > 1").count() == 0
    raw = spark.read.parquet(f"{out}/raw-data/staging_daily_load")
    assert raw.count() == 2 * m1["records_extracted"]  # each run lands what it read
    assert raw.selectExpr("variant_get(raw_data, '$.delivery_id', 'bigint') as d").where("d is null").count() == 0
    assert spark.read.json(f"{out}/etl_metrics").count() == 1  # one row a batch
    assert t["dim_time"].count() == 1440
    # every fact found its driver and vehicle version
    assert facts2.where((F.col("driver_key") == -1) | (F.col("vehicle_key") == -1)).count() == 0


def _at(hours, i):
    """A delivery of the scheduled day S, delivered so many hours after midnight."""
    return (i, 1, f"FL{i}", "Ana", "Calle 1, B", D("1.00"), S, T(2001, 7, 31) + dt.timedelta(hours=hours), "delivered", True)


def test_later_batches_keep_earlier_facts(spark, tmp_dir):
    f = _fleet(spark, [_at(h, i) for i, h in enumerate((11, 12, 13, 20, 30, 40), 1)])
    out = os.path.join(tmp_dir, "wh")
    ids = lambda: sorted(r.delivery_id for r in B.stored(spark, out)["fact_deliveries"].collect())
    one = dict(start="2001-07-31 00:00:00", end="2001-07-31 18:00:00")
    B.run_daily(spark, f, out, "2001-08-01 00:00:00", 1, **one)
    assert ids() == [1, 2, 3]
    two = dict(start="2001-07-31 12:30:00", end="2001-08-02 00:00:00")  # overlaps, and comes late for the day
    m = B.run_daily(spark, f, out, "2001-08-02 00:00:00", 2, **two)
    assert ids() == [1, 2, 3, 4, 5, 6] and m["records_loaded"] == 3
    (c,) = B.stored(spark, out)["dim_customer"].collect()
    assert c.total_deliveries == 6
    views = B.stored_views(spark, out)
    assert views["v_sales"].count() == views["v_operations"].count() == 6
    for batch, as_of, window in ((1, "2001-08-01 00:00:00", one), (2, "2001-08-02 00:00:00", two)):
        B.run_daily(spark, f, out, as_of, batch, **window)
        assert ids() == [1, 2, 3, 4, 5, 6]
    (day,) = B.stored(spark, out)["daily_totals"].where("date_key = 20010802").collect()
    assert day.total_deliveries == 0


def test_broken_run_is_not_seen(spark, tmp_dir, monkeypatch):
    f = _fleet(spark, [_at(11, 1), _at(30, 2)])
    out = os.path.join(tmp_dir, "wh")
    B.run_daily(spark, f, out, "2001-08-01 00:00:00", 1, start="2001-07-31 00:00:00", end="2001-07-31 18:00:00")
    monkeypatch.setattr(B, "_totals", lambda *a, **k: 1 / 0)
    try:
        B.run_daily(spark, f, out, "2001-08-02 00:00:00", 2, start="2001-07-31 18:00:00", end="2001-08-03 00:00:00")
    except ZeroDivisionError:
        pass
    assert [r.delivery_id for r in B.stored(spark, out)["fact_deliveries"].collect()] == [1]


def test_second_batch_versions_changed_drivers(spark, tmp_dir):
    from dataclasses import replace

    fleet = cached_fleet(spark, SF_SMALL)
    out = os.path.join(tmp_dir, "wh2")
    B.run_daily(spark, fleet, out, "2001-08-01 00:00:00", batch_id=1)
    d1 = B.stored(spark, out)["dim_driver"]
    flip = F.when(F.col("status") == "active", "inactive").otherwise("active")
    changed = fleet.drivers.withColumn("status", F.when(F.col("driver_id") % 5 == 0, flip)
                                       .otherwise(F.col("status")))
    B.run_daily(spark, replace(fleet, drivers=changed), out, "2001-08-02 00:00:00", batch_id=2,
                start="2001-07-01 00:00:00", end="2001-08-02 00:00:00")

    d2 = B.stored(spark, out)["dim_driver"]
    n_drivers = fleet.drivers.count()
    assert d1.count() == n_drivers
    n_changed = fleet.drivers.where(F.col("driver_id") % 5 == 0).count()
    assert d2.count() == n_drivers + n_changed                  # closed + reopened rows
    assert d2.where("is_current").count() == n_drivers
    closed = d2.where("not is_current")
    assert closed.count() == n_changed
    assert {str(r.valid_to) for r in closed.select("valid_to").distinct().collect()} == {"2001-08-02"}
    # facts of batch 2 are scheduled before the change: they keep the old versions
    facts = B.stored(spark, out)["fact_deliveries"].where("etl_batch_id = 2")
    old_keys = {r.driver_key for r in d1.select("driver_key").collect()}
    assert facts.count() > 0
    assert {r.driver_key for r in facts.select("driver_key").collect()} <= old_keys


def test_idle_driver_keeps_the_rating(spark, tmp_dir):
    f = _fleet(spark, [_at(10.2, 1)])  # twelve minutes late: on time
    out = os.path.join(tmp_dir, "wh")
    B.run_daily(spark, f, out, "2001-08-01 00:00:00", 1, start="2001-07-31 00:00:00", end="2001-08-01 00:00:00")
    rating = lambda: [r.performance_category for r in B.stored(spark, out)["dim_driver"].collect()]
    assert rating() == ["Alto"]
    g = _fleet(spark, [_at(10.2, 1), _at(60, 2)])
    B.run_daily(spark, g, out, "2001-08-03 00:00:00", 2, start="2001-08-01 00:00:00", end="2001-08-02 00:00:00")
    assert rating() == ["Alto"]
