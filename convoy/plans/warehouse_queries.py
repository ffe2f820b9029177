"""Registered warehouse queries (one batch planned in memory).

The batch used here is the full-history backfill (``last_day=False``) so the
queries cover the whole tables; ``daily_extract`` keeps the source's
last-day window, which is the feature of that step. Surrogate key columns
(``xxhash64``) are left out of the registered outputs so they can be compared
with an SQL engine that hashes differently.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.operators.merge import scd2_apply
from convoy.plans import batches as B
from convoy.plans import warehouse as W
from convoy.plans.reports import DEFAULT_AS_OF
from convoy.session import checkpoint_dir
from convoy.sources.fleet import Fleet
from convoy.sources.sinks import path_exists

BATCH_DATE = "2001-08-01"
NATURAL_KEYS = {"delivery": "delivery_id", "vehicle": "vehicle_id", "driver": "driver_id",
                "route": "route_id", "customer": "customer_name"}


def backfill_facts(fleet: Fleet) -> DataFrame:
    acc, _ = W.measures(W.extract(fleet, last_day=False))
    return W.fact_rows(acc)


def daily_extract(fleet: Fleet) -> DataFrame:
    return W.extract(fleet).drop("deliveries_in_trip")


def fact_measures(fleet: Fleet) -> DataFrame:
    return backfill_facts(fleet)


def fact_rejects(fleet: Fleet) -> DataFrame:
    _, rej = W.measures(W.extract(fleet, last_day=False))
    return rej.select("delivery_id", "reject_reason",
                      F.col("delivery_time_minutes").alias("delivery_time_minutes"),
                      "package_weight_kg")


def daily_totals(fleet: Fleet) -> DataFrame:
    return W.daily_totals(backfill_facts(fleet), batch_id="1", date_update=BATCH_DATE,
                          keys=NATURAL_KEYS)


def dim_customer(fleet: Fleet) -> DataFrame:
    return W.customer_rows(backfill_facts(fleet)).drop("customer_key")


def dim_vehicle(fleet: Fleet) -> DataFrame:
    snap = W.vehicle_snapshot(fleet, DEFAULT_AS_OF)
    return scd2_apply(None, snap, "vehicle_id",
                      ["license_plate", "vehicle_type", "capacity_kg", "fuel_type", "status"],
                      BATCH_DATE, "vehicle_key").drop("vehicle_key")


def dim_driver(fleet: Fleet) -> DataFrame:
    snap = W.driver_snapshot(fleet, DEFAULT_AS_OF, W.on_time_rates(backfill_facts(fleet)))
    return W.rated(scd2_apply(None, snap, "driver_id", ["employee_code", "full_name", "status"],
                              BATCH_DATE, "driver_key",
                              type1=["performance_category", "experience_months"])).drop("driver_key")


def dim_route(fleet: Fleet) -> DataFrame:
    return W.dim_route(fleet).drop("route_key")


def dim_date(fleet: Fleet) -> DataFrame:
    return W.dim_date_from(backfill_facts(fleet))


SCD2_FIRST = "2001-07-01"
SCD2_SECOND = "2001-08-01"


def scd2_drivers(fleet: Fleet) -> DataFrame:
    """Two snapshots of the driver table applied to a type-2 dimension.

    Snapshot 1: drivers whose id is not a multiple of 11 (the rest arrive
    later). Snapshot 2: every driver, with the status of every 7th driver
    flipped - so the batch has unchanged, changed, new and absent keys.
    """
    base = fleet.drivers.select("driver_id", "employee_code", "license_number", "status")
    first = base.where(F.col("driver_id") % 11 != 0)
    flip = F.when(F.col("status") == "active", "inactive").otherwise("active")
    second = base.withColumn("status", F.when(F.col("driver_id") % 7 == 0, flip)
                             .otherwise(F.col("status")))
    second = second.where(F.col("driver_id") % 13 != 0)
    tracked = ["employee_code", "license_number", "status"]
    d1 = scd2_apply(None, first, "driver_id", tracked, SCD2_FIRST, "driver_key")
    d2 = scd2_apply(d1, second, "driver_id", tracked, SCD2_SECOND, "driver_key")
    return d2.drop("driver_key")


def _full_build(spark: SparkSession, fleet: Fleet) -> W.Warehouse:
    return W.build(spark, fleet, DEFAULT_AS_OF, batch_id=1, last_day=False,
                   etl_ts=DEFAULT_AS_OF)


def v_sales(spark: SparkSession, fleet: Fleet) -> DataFrame:
    wh = _full_build(spark, fleet)
    return W.v_sales(wh.fact_deliveries, wh.dim_date, wh.dim_customer)


def v_operations(spark: SparkSession, fleet: Fleet) -> DataFrame:
    wh = _full_build(spark, fleet)
    return W.v_operations(wh.fact_deliveries, wh.dim_date, wh.dim_time, wh.dim_vehicle,
                          wh.dim_driver, wh.dim_route, wh.dim_customer)


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/convoy-warehouse-{uuid.uuid4().hex}"


KEYS = ("delivery_key", "vehicle_key", "driver_key", "route_key", "customer_key")


def daily_run(spark: SparkSession, fleet: Fleet) -> DataFrame:
    """End-to-end daily batch as the source runs it (last-day window) into a
    fresh folder under the shared checkpoint folder: dimensions, facts,
    totals and metrics are written; the loaded fact table is read back
    (without the hash keys and the load timestamp)."""
    out = _folder(spark)
    B.run_daily(spark, fleet, out, DEFAULT_AS_OF, batch_id=1)
    return B.stored(spark, out)["fact_deliveries"].drop(*KEYS, "etl_timestamp")


#: Delivered-time windows and clocks of two batches. The second begins half a day
#: before the first ends, so deliveries come again, and late ones fall on days
#: that the first has loaded.
WINDOWS = [("1990-01-01 00:00:00", "1998-07-01 00:00:00", "1998-07-01 00:00:00"),
           ("1998-06-30 12:00:00", "2030-01-01 00:00:00", "2000-01-01 00:00:00")]


def second_day(fleet: Fleet) -> Fleet:
    """The fleet as the second batch sees it: the status of every seventh driver
    has changed, and drivers whose id leaves 5 on division by 50 are renamed."""
    flip = F.when(F.col("status") == "active", "inactive").otherwise("active")
    d = fleet.drivers.withColumn("status", F.when(F.col("driver_id") % 7 == 0, flip).otherwise(F.col("status")))
    d = d.withColumn("last_name", F.when(F.col("driver_id") % 50 == 5, "Renamed").otherwise(F.col("last_name")))
    return replace(fleet, drivers=d)


#: Three batches for corrections: the second begins half a year before the first
#: ends, the third goes over two months that both have loaded.
CORRECTED = [WINDOWS[0], ("1998-01-01 00:00:00", *WINDOWS[1][1:]), ("1998-04-01 00:00:00", "1998-06-01 00:00:00", "2000-02-01 00:00:00")]


def corrected_day(fleet: Fleet, batch: int) -> Fleet:
    """The fleet as batch 1, 2 or 3 of :data:`CORRECTED` sees it. From the second on, deliveries
    whose id leaves 3 on division by 10 were scheduled a day earlier and weigh a
    kilogram more; in the third, every other of them is as it was at first."""
    if batch == 1:
        return fleet
    wrong = F.col("delivery_id") % (10 if batch == 2 else 20) == (3 if batch == 2 else 13)
    d = (fleet.deliveries
         .withColumn("scheduled_datetime", F.when(wrong, F.col("scheduled_datetime") - F.expr("interval 1 day")).otherwise(F.col("scheduled_datetime")))
         .withColumn("package_weight_kg", F.when(wrong, F.col("package_weight_kg") + 1).otherwise(F.col("package_weight_kg")).cast("decimal(10,2)")))
    return replace(second_day(fleet), deliveries=d)


_STORED: dict[tuple, str] = {}


def _warehouse(spark: SparkSession, fleet: Fleet, name: str, steps: list[tuple]) -> str:
    """Folder of a warehouse after ``steps`` (batch, fleet, window); run once for each set
    of fleet tables and scratch folder, then read by every query over it."""
    key = (name, checkpoint_dir(spark), min(fleet.trips.inputFiles()))
    if key not in _STORED or not path_exists(spark, _STORED[key]):
        out = _folder(spark)
        for batch, seen, (start, end, as_of) in steps:
            B.run_daily(spark, seen, out, as_of, batch, start, end)
        _STORED[key] = out
    return _STORED[key]


def _two_batches(spark: SparkSession, fleet: Fleet) -> str:
    return _warehouse(spark, fleet, "two", [(1, fleet, WINDOWS[0]), (2, second_day(fleet), WINDOWS[1])])


def _corrected(spark: SparkSession, fleet: Fleet, order: list[int]) -> str:
    return _warehouse(spark, fleet, f"corrected {order}", [(b, corrected_day(fleet, b), CORRECTED[b - 1]) for b in order])


def _reordered(spark: SparkSession, fleet: Fleet) -> dict[str, DataFrame]:
    """The three batches loaded out of order, the first of them twice."""
    return B.stored(spark, _corrected(spark, fleet, [1, 3, 2, 1]))


def corrected_facts(spark: SparkSession, fleet: Fleet) -> DataFrame:
    """Facts after corrections of stored deliveries, batches loaded in order."""
    return B.stored(spark, _corrected(spark, fleet, [1, 2, 3]))["fact_deliveries"].drop(*KEYS, "etl_timestamp")


def corrected_totals(spark: SparkSession, fleet: Fleet) -> DataFrame:
    """Stored totals of all days with facts; each batch rolled up the days it touched."""
    t = B.stored(spark, _corrected(spark, fleet, [1, 2, 3]))["daily_totals"]
    return t.where("total_deliveries > 0").drop("date_update", "etl_batch_id")


def reordered_facts(spark: SparkSession, fleet: Fleet) -> DataFrame:
    return _reordered(spark, fleet)["fact_deliveries"].drop(*KEYS, "etl_timestamp")


def reordered_customers(spark: SparkSession, fleet: Fleet) -> DataFrame:
    return _reordered(spark, fleet)["dim_customer"].drop("customer_key")


def reordered_drivers(spark: SparkSession, fleet: Fleet) -> DataFrame:
    return _reordered(spark, fleet)["dim_driver"].drop("driver_key")


def reordered_dates(spark: SparkSession, fleet: Fleet) -> DataFrame:
    return _reordered(spark, fleet)["dim_date"]


def reordered_totals(spark: SparkSession, fleet: Fleet) -> DataFrame:
    return _reordered(spark, fleet)["daily_totals"].where("total_deliveries > 0").drop("date_update", "etl_batch_id")


def batch_metrics(spark: SparkSession, fleet: Fleet) -> DataFrame:
    """What each of the two batches extracted, accepted and has in effect."""
    m = spark.read.json(f"{_two_batches(spark, fleet)}/etl_metrics").drop("batch")
    return m.select("batch_id", "records_extracted", "records_transformed", "records_loaded", "errors")


def two_day_run(spark: SparkSession, fleet: Fleet) -> DataFrame:
    """The facts stored after two batches with overlapping windows."""
    return B.stored(spark, _two_batches(spark, fleet))["fact_deliveries"].drop(*KEYS, "etl_timestamp")


def two_day_customers(spark: SparkSession, fleet: Fleet) -> DataFrame:
    """The customer dimension that the second batch merged into the first one's."""
    return B.stored(spark, _two_batches(spark, fleet))["dim_customer"].drop("customer_key")


def two_day_drivers(spark: SparkSession, fleet: Fleet) -> DataFrame:
    """The driver dimension after a second batch with changed, renamed and idle drivers."""
    return B.stored(spark, _two_batches(spark, fleet))["dim_driver"].drop("driver_key")


def fact_driver_versions(spark: SparkSession, fleet: Fleet) -> DataFrame:
    """Which version of its driver each stored fact meets (point-in-time key)."""
    t = B.stored(spark, _two_batches(spark, fleet))
    v = t["dim_driver"].select("driver_key", "driver_id", "full_name", "status", "valid_from", "valid_to")
    f = t["fact_deliveries"].select("delivery_id", "date_key", "driver_key")
    return f.join(v, "driver_key", "left").drop("driver_key")


def stored_sales(spark: SparkSession, fleet: Fleet) -> DataFrame:
    return B.stored_views(spark, _two_batches(spark, fleet))["v_sales"]


def stored_operations(spark: SparkSession, fleet: Fleet) -> DataFrame:
    return B.stored_views(spark, _two_batches(spark, fleet))["v_operations"]


def day_totals(fleet: Fleet) -> DataFrame:
    """Single-day totals as the source asks for them: a day with facts, and one without."""
    facts = backfill_facts(fleet)
    day = lambda k: W.daily_totals(facts, date_key=k, batch_id="1", date_update=BATCH_DATE, keys=NATURAL_KEYS)
    return day(19970615).unionByName(day(20300101))
