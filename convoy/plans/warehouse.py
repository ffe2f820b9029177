"""Daily star-schema batch: extract -> measures -> dimensions -> facts -> totals.

Every step is a lazy DataFrame.

Scale notes:

* the extract filters deliveries on ``delivered_datetime`` before any join
  (the bounds are resolved first, so they reach the scan as literals);
* drivers only test existence in the extract, so they join as a left semi
  join; all tables are joined by key with AQE choosing broadcast at runtime
  when one is small;
* deliveries per trip are a ``groupBy(trip_id)`` joined back (partial
  aggregation), not a window, so a trip with a huge number of rows never
  gathers in one task;
* surrogate keys are ``xxhash64`` of the business key (and validity start) -
  no global row numbering;
* this module plans; :mod:`convoy.plans.batches` stores batches.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.functions import columns as C
from convoy.operators.key_index import key_blocks
from convoy.operators.lineage import materialize
from convoy.operators.merge import point_in_time, scd2_apply, surrogate_key
from convoy.sources.fleet import Fleet

# Fixed values of the cost model of the source batch.
FUEL_PRICE_PER_LITER = 5000
REVENUE_BASE = 20000
REVENUE_PER_KG = 500
MAX_PACKAGE_KG = 10000

# Validity start of the versions of an initial load.
INITIAL_VALID_FROM = "1900-01-01"

# The labels the source's dimensional model declares.
TIME_OF_DAY_LABELS = ("Madrugada", "Mañana", "Tarde", "Noche")
SHIFT_LABELS = ("Turno 1", "Turno 2", "Turno 3")
PERFORMANCE_LABELS = ("Alto", "Medio", "Bajo")
DIFFICULTY_LABELS = ("Fácil", "Medio", "Difícil")
ROUTE_TYPE_LABELS = ("Urbana", "Interurbana", "Rural")
CUSTOMER_CATEGORY_LABELS = ("Ocasional", "Regular", "Premium")
DEFAULT_CUSTOMER_TYPE = "Individual"
EXCLUDED_SALES_CUSTOMER_TYPE = "Gobierno"

# Label thresholds where the source names labels but gives no rule
# (our choice, all parameters).
ROUTE_TYPE_KM = (150, 600)            # Urbana < 150 <= Interurbana < 600 <= Rural
DIFFICULTY_KM = (300, 700)            # Facil < 300 <= Medio < 700 <= Dificil
CUSTOMER_CATEGORY_N = (3, 10)         # Ocasional < 3 <= Regular < 10 <= Premium
PERFORMANCE_ON_TIME = (0.95, 0.85)    # Alto >= 0.95 > Medio >= 0.85 > Bajo

# The columns of the source extract.
EXTRACT_COLUMNS = [
    "vehicle_id", "driver_id", "route_id", "delivery_id", "trip_id", "tracking_number",
    "package_weight_kg", "distance_km", "fuel_consumed_liters", "delivered_datetime",
    "delivery_status", "scheduled_datetime", "departure_datetime", "estimated_duration_hours",
    "toll_cost", "recipient_signature", "arrival_datetime", "customer_name",
    "destination_city", "license_plate",
]


def pd_round(x, scale: int = 2):
    """Round like the source's float rounding: scale, round half to even on
    the binary value, unscale (``rint(x * 10^s) / 10^s``)."""
    f = float(10 ** scale)
    return F.rint(x * F.lit(f)) / F.lit(f)


# L1 ----------------------------------------------------------------------
def extract(fleet: Fleet, start=None, end=None, last_day: bool = True) -> DataFrame:
    """Deliveries with their trip, route and vehicle attributes, plus the
    number of extracted deliveries of each trip.

    Default window: ``[max(delivered) - 1 day, max(delivered))`` (the newest
    delivery itself is excluded, as in the source). The bounds are resolved
    first (one aggregate over one column) so they reach the parquet scan as
    literal filters. ``last_day=False`` with no bounds extracts the whole
    history (backfill).
    """
    d = fleet.deliveries
    if start is None and end is None and last_day:
        newest = d.agg(F.max("delivered_datetime")).first()[0]
        if newest is not None:
            start, end = newest - _dt.timedelta(days=1), newest
        else:
            d = d.limit(0)
    ts = lambda v: F.lit(v).cast("timestamp_ntz") if not isinstance(v, F.Column) else v
    if start is not None:
        d = d.where(F.col("delivered_datetime") >= ts(start))
    if end is not None:
        d = d.where(F.col("delivered_datetime") < ts(end))
    # Every other extract condition (driver, route, vehicle exist) is a
    # property of the trip, so a trip's count is taken on the deliveries
    # alone (partial aggregation by trip) rather than on the joined rows.
    per_trip = d.groupBy("trip_id").agg(F.count(F.lit(1)).alias("deliveries_in_trip"))
    t = fleet.trips.select("trip_id", "vehicle_id", "driver_id", "route_id",
                           "fuel_consumed_liters", "departure_datetime", "arrival_datetime")
    r = fleet.routes.select("route_id", "distance_km", "estimated_duration_hours",
                            "toll_cost", "destination_city")
    v = fleet.vehicles.select("vehicle_id", "license_plate")
    drivers = fleet.drivers.select("driver_id")
    x = (d.join(per_trip, "trip_id").join(t, "trip_id")
         .join(drivers, "driver_id", "left_semi")
         .join(r, "route_id")
         .join(v, "vehicle_id"))
    return x.select(*EXTRACT_COLUMNS, "deliveries_in_trip")


# L2-L5 -------------------------------------------------------------------
def measures(extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delivery and trip measures; returns ``(accepted, rejected)``.

    Rejected rows carry a ``reject_reason``: negative or unknown delivery
    time, or a package weight outside (0, 10000) kg.
    """
    return split_measured(measured(extracted))


#: Columns that the day states read.
FACT_STUB = ("date_key int, package_weight_kg decimal(10,2), distance_km decimal(10,2), fuel_consumed_liters decimal(10,2), "
             "deliveries_per_hour decimal(10,2), fuel_efficiency_km_per_liter decimal(10,2), cost_per_delivery decimal(12,2), "
             "revenue_per_delivery decimal(12,2), delivery_time_minutes int, delay_minutes int, is_on_time boolean, "
             "is_damaged boolean, delivery_status string, customer_name string, vehicle_id long, driver_id long, route_id long")


def split_measured(x: DataFrame) -> tuple[DataFrame, DataFrame]:
    accepted = (x.where(F.col("reject_reason").isNull()).drop("reject_reason")
                .withColumn("valid_from", F.to_date("scheduled_datetime"))
                .withColumn("valid_to", F.lit(C.OPEN_VALID_TO).cast("date"))
                .withColumn("is_current", F.lit(True)))
    rejected = x.where(F.col("reject_reason").isNotNull())
    return accepted, rejected


def measured(extracted: DataFrame) -> DataFrame:
    """Every extracted row with its measures and ``reject_reason`` (NULL when
    the row passes the quality filters)."""
    x = extracted
    if "deliveries_in_trip" not in x.columns:
        per_trip = x.groupBy("trip_id").agg(F.count(F.lit(1)).alias("deliveries_in_trip"))
        x = x.join(per_trip, "trip_id")
    minutes = pd_round(C.minutes_between("scheduled_datetime", "delivered_datetime"))
    fuel = F.col("fuel_consumed_liters").cast("double")
    km = F.col("distance_km").cast("double")
    n = F.col("deliveries_in_trip").cast("double")
    x = (x.withColumn("delivery_time_minutes", minutes)
         .withColumn("delay_minutes",
                     F.when(F.col("delivery_time_minutes") > 0, F.col("delivery_time_minutes"))
                     .otherwise(F.lit(0.0)))
         .withColumn("is_on_time", F.col("delay_minutes") <= C.ON_TIME_MAX_DELAY_MIN)
         .withColumn("trip_duration_hours",
                     pd_round(C.hours_between("departure_datetime", "arrival_datetime")))
         .withColumn("deliveries_per_hour",
                     pd_round(F.try_divide(n, F.col("trip_duration_hours"))))
         .withColumn("fuel_efficiency_km_per_liter", pd_round(F.try_divide(km, fuel)))
         .withColumn("cost_per_delivery",
                     pd_round(F.try_divide(fuel * F.lit(float(FUEL_PRICE_PER_LITER))
                                           + F.col("toll_cost").cast("double"), n)))
         .withColumn("revenue_per_delivery",
                     pd_round(F.lit(float(REVENUE_BASE))
                              + F.col("package_weight_kg").cast("double") * F.lit(float(REVENUE_PER_KG)))))
    kg = F.col("package_weight_kg")
    time_ok = F.coalesce(F.col("delivery_time_minutes") >= 0, F.lit(False))
    weight_ok = F.coalesce((kg > 0) & (kg < MAX_PACKAGE_KG), F.lit(False))
    reason = (F.when(~time_ok, F.lit("delivery_time"))
              .when(~weight_ok, F.lit("package_weight")))
    return x.withColumn("reject_reason", reason)


def fact_rows(accepted: DataFrame) -> DataFrame:
    """Typed fact columns (natural ids, no surrogate keys yet)."""
    return accepted.select(
        "delivery_id", "trip_id", "vehicle_id", "driver_id", "route_id", "customer_name",
        "tracking_number",
        C.yyyymmdd("scheduled_datetime").alias("date_key"),
        C.hour_key("scheduled_datetime").alias("scheduled_time_key"),
        C.hour_key("delivered_datetime").alias("delivered_time_key"),
        "package_weight_kg", "distance_km", "fuel_consumed_liters",
        F.round("delivery_time_minutes", 0).cast("int").alias("delivery_time_minutes"),
        F.round("delay_minutes", 0).cast("int").alias("delay_minutes"),
        F.col("deliveries_per_hour").cast("decimal(10,2)").alias("deliveries_per_hour"),
        F.col("fuel_efficiency_km_per_liter").cast("decimal(10,2)").alias("fuel_efficiency_km_per_liter"),
        F.col("cost_per_delivery").cast("decimal(12,2)").alias("cost_per_delivery"),
        F.col("revenue_per_delivery").cast("decimal(12,2)").alias("revenue_per_delivery"),
        "is_on_time",
        F.lit(False).alias("is_damaged"),
        F.col("recipient_signature").alias("has_signature"),
        "delivery_status",
        "scheduled_datetime",
        "destination_city",
    )


# Dimensions ----------------------------------------------------------------
def _months(later, earlier) -> F.Column:
    return F.floor(F.months_between(later, earlier)).cast("int")


def vehicle_snapshot(fleet: Fleet, as_of) -> DataFrame:
    """Vehicle attributes as of ``as_of`` (age, last maintenance)."""
    d = F.to_date(F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of)
    last = (fleet.maintenance.where(F.col("maintenance_date") <= d)
            .groupBy("vehicle_id").agg(F.max("maintenance_date").alias("last_maintenance_date")))
    return (fleet.vehicles.join(last, "vehicle_id", "left")
            .select("vehicle_id", "license_plate", "vehicle_type", "capacity_kg", "fuel_type",
                    "acquisition_date", _months(d, F.col("acquisition_date")).alias("age_months"),
                    "status", "last_maintenance_date"))


def on_time_rates(facts: DataFrame) -> DataFrame:
    """Share of on-time deliveries per driver."""
    return facts.groupBy("driver_id").agg(F.avg(F.col("is_on_time").cast("double")).alias("on_time_rate"))


def driver_snapshot(fleet: Fleet, as_of, rates: DataFrame | None = None) -> DataFrame:
    """Driver attributes as of ``as_of``; see :func:`with_rating`."""
    d = batch_date(as_of)
    return with_rating(fleet.drivers.select(
        "driver_id", "employee_code", C.full_name().alias("full_name"), "license_number", "license_expiry", "phone",
        "hire_date", _months(d, F.col("hire_date")).alias("experience_months"), "status"), rates)


def with_rating(drivers: DataFrame, rates: DataFrame | None) -> DataFrame:
    """Drivers with the label of their on-time share. It is NULL for a driver without
    deliveries, so that a stored rating stays (see :func:`rated`)."""
    drivers = drivers.drop("performance_category")
    if rates is None:
        return drivers.withColumn("performance_category", F.lit(None).cast("string"))
    hi, mid = PERFORMANCE_ON_TIME
    rate = F.col("on_time_rate")
    alto, medio, bajo = PERFORMANCE_LABELS
    label = F.when(rate >= hi, alto).when(rate >= mid, medio).when(rate.isNotNull(), bajo)
    return drivers.join(rates, "driver_id", "left").withColumn("performance_category", label).drop("on_time_rate")


def rated(drivers: DataFrame) -> DataFrame:
    """Drivers never rated yet get the middle label."""
    return drivers.withColumn("performance_category", F.coalesce(
        "performance_category", F.lit(PERFORMANCE_LABELS[1])))


def dim_route(fleet: Fleet) -> DataFrame:
    km = F.col("distance_km")
    u, i = ROUTE_TYPE_KM
    e, m = DIFFICULTY_KM
    return fleet.routes.select(
        surrogate_key("route_id").alias("route_key"), "route_id", "route_code",
        "origin_city", "destination_city", "distance_km", "estimated_duration_hours", "toll_cost",
        F.when(km < e, DIFFICULTY_LABELS[0]).when(km < m, DIFFICULTY_LABELS[1])
        .otherwise(DIFFICULTY_LABELS[2]).alias("difficulty_level"),
        F.when(km < u, ROUTE_TYPE_LABELS[0]).when(km < i, ROUTE_TYPE_LABELS[1])
        .otherwise(ROUTE_TYPE_LABELS[2]).alias("route_type"))


def _customer_category(n: F.Column) -> F.Column:
    lo, hi = CUSTOMER_CATEGORY_N
    ocasional, regular, premium = CUSTOMER_CATEGORY_LABELS
    return F.when(n < lo, ocasional).when(n < hi, regular).otherwise(premium)


def customer_rows(facts: DataFrame) -> DataFrame:
    """One row per customer name seen in the facts (namesakes merge, as the
    source keys customers by name)."""
    agg = facts.groupBy("customer_name").agg(
        F.min_by("destination_city", "delivery_id").alias("city"),
        F.min(F.to_date("scheduled_datetime")).alias("first_delivery_date"),
        F.count(F.lit(1)).alias("total_deliveries"))
    n = F.col("total_deliveries")
    return agg.select(
        surrogate_key("customer_name").alias("customer_key"),
        "customer_name", F.lit(DEFAULT_CUSTOMER_TYPE).alias("customer_type"), "city",
        "first_delivery_date", n.cast("int").alias("total_deliveries"),
        _customer_category(n).alias("customer_category"))


def customer_parts(facts: DataFrame, *by: str) -> DataFrame:
    """Mergeable customer state: deliveries, first day, and the city of the first
    delivery (by batch, then id)."""
    return facts.groupBy(*by, "customer_name").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.to_date("scheduled_datetime")).alias("first"),
        F.min(F.struct("etl_batch_id", "delivery_id", "destination_city")).alias("seen"))


def customers_of(parts: DataFrame) -> DataFrame:
    """The customer dimension out of :func:`customer_parts` of any disjoint facts."""
    agg = parts.groupBy("customer_name").agg(
        F.sum("n").alias("n"), F.min("first").alias("first_delivery_date"), F.min("seen").alias("seen"))
    return agg.select(
        surrogate_key("customer_name").alias("customer_key"), "customer_name",
        F.lit(DEFAULT_CUSTOMER_TYPE).alias("customer_type"), F.col("seen.destination_city").alias("city"),
        "first_delivery_date", F.col("n").cast("int").alias("total_deliveries"),
        _customer_category(F.col("n")).alias("customer_category"))


def dim_date(spark: SparkSession, start, end, holidays: DataFrame | None = None) -> DataFrame:
    """Calendar rows for every day in [start, end] (columns or literals)."""
    s = F.lit(start).cast("date") if isinstance(start, str) else start
    e = F.lit(end).cast("date") if isinstance(end, str) else end
    days = spark.range(1).select(F.explode(F.sequence(s, e)).alias("full_date"))
    return _calendar(days, holidays)


def dim_date_from(facts: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Calendar covering the scheduled dates of the facts (span from data)."""
    span = facts.agg(F.min(F.to_date("scheduled_datetime")).alias("s"),
                     F.max(F.to_date("scheduled_datetime")).alias("e"))
    days = span.select(F.explode(F.sequence("s", "e")).alias("full_date"))
    return _calendar(days, holidays)


def dim_date_of_keys(keys: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Calendar from the first to the last ``date_key`` of ``keys``."""
    day = lambda c: F.to_date(c.cast("string"), "yyyyMMdd")
    span = keys.agg(day(F.min("date_key")).alias("s"), day(F.max("date_key")).alias("e"))
    return _calendar(span.select(F.explode(F.sequence("s", "e")).alias("full_date")), holidays)


def _calendar(days: DataFrame, holidays: DataFrame | None) -> DataFrame:
    d = F.col("full_date")
    out = days.select(
        C.yyyymmdd(d).alias("date_key"), d,
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"), F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"), F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"), F.quarter(d).alias("quarter"),
        F.year(d).alias("year"), (F.weekday(d) >= 5).alias("is_weekend"),
        F.quarter(d).alias("fiscal_quarter"), F.year(d).alias("fiscal_year"))
    if holidays is None:
        out = out.withColumn("holiday_name", F.lit(None).cast("string"))
    else:
        h = holidays.select(F.col("holiday_date").alias("full_date"), "holiday_name")
        out = out.join(h, "full_date", "left")
    return out.withColumn("is_holiday", F.col("holiday_name").isNotNull()).select(
        "date_key", "full_date", "day_of_week", "day_name", "day_of_month", "day_of_year",
        "week_of_year", "month_num", "month_name", "quarter", "year", "is_weekend",
        "is_holiday", "holiday_name", "fiscal_quarter", "fiscal_year")


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per minute of the day; key HHMM (so HH00 hour keys resolve)."""
    m = spark.range(0, 1440).select(F.col("id").cast("int").alias("m"))
    h = (F.col("m") / 60).cast("int")
    mi = F.col("m") % 60
    h12 = F.when(h % 12 == 0, 12).otherwise(h % 12)
    return m.select(
        (h * 100 + mi).alias("time_key"), h.alias("hour"), mi.alias("minute"),
        F.lit(0).alias("second"),
        F.when(h < 6, TIME_OF_DAY_LABELS[0]).when(h < 12, TIME_OF_DAY_LABELS[1])
        .when(h < 18, TIME_OF_DAY_LABELS[2]).otherwise(TIME_OF_DAY_LABELS[3]).alias("time_of_day"),
        F.format_string("%02d:%02d", h, mi).alias("hour_24"),
        F.format_string("%02d:%02d %s", h12, mi, F.when(h < 12, "AM").otherwise("PM")).alias("hour_12"),
        F.when(h < 12, "AM").otherwise("PM").alias("am_pm"),
        ((h >= 8) & (h < 18)).alias("is_business_hour"),
        F.when((h >= 6) & (h < 14), SHIFT_LABELS[0]).when((h >= 14) & (h < 22), SHIFT_LABELS[1])
        .otherwise(SHIFT_LABELS[2]).alias("shift"))


# Facts and totals ---------------------------------------------------------
def keyed_facts(facts: DataFrame, dim_vehicle: DataFrame, dim_driver: DataFrame,
                routes: DataFrame, batch_id: int | None = None, etl_ts=None) -> DataFrame:
    """Attach surrogate keys: point-in-time for the SCD2 dimensions, equi-join
    for routes; unknown members get -1. Every named customer of a fact is in
    the customer dimension, whose key is a function of the name. Without
    ``batch_id`` the facts carry their own batch and load time."""
    f = point_in_time(facts, dim_vehicle, "vehicle_id", "scheduled_datetime", "vehicle_key")
    f = point_in_time(f, dim_driver, "driver_id", "scheduled_datetime", "driver_key")
    f = f.join(routes.select("route_id", "route_key"), "route_id", "left")
    customer = F.when(F.col("customer_name").isNotNull(), surrogate_key("customer_name"))
    if batch_id is not None:
        f = with_batch(f, batch_id, etl_ts)
    return f.select(
        surrogate_key("delivery_id").alias("delivery_key"), "date_key", "scheduled_time_key",
        "delivered_time_key", "vehicle_key", "driver_key",
        F.coalesce("route_key", F.lit(-1).cast("bigint")).alias("route_key"),
        F.coalesce(customer, F.lit(-1).cast("bigint")).alias("customer_key"),
        "delivery_id", "trip_id", "tracking_number", "package_weight_kg", "distance_km",
        "fuel_consumed_liters", "delivery_time_minutes", "delay_minutes", "deliveries_per_hour",
        "fuel_efficiency_km_per_liter", "cost_per_delivery", "revenue_per_delivery",
        "is_on_time", "is_damaged", "has_signature", "delivery_status", "etl_batch_id", "etl_timestamp")


def with_batch(facts: DataFrame, batch_id: int, etl_ts=None) -> DataFrame:
    ts = F.localtimestamp() if etl_ts is None else F.lit(etl_ts).cast("timestamp_ntz")
    return facts.withColumn("etl_batch_id", F.lit(batch_id).cast("int")).withColumn("etl_timestamp", ts)


def daily_totals(fact: DataFrame, date_key: int | None = None, batch_id: str = "",
                 date_update=None, keys: dict | None = None) -> DataFrame:
    """Daily rollup of the fact table.

    With ``date_key`` it is one row for that day, even when empty (the
    source's behaviour); without, one row per ``date_key``. Counts are plain
    row counts of the key columns as in the source, with ``*_distinct``
    companions. ``keys`` maps vehicle/driver/route/customer/delivery to the
    key column names (default ``*_key``).
    """
    k = {"delivery": "delivery_key", "vehicle": "vehicle_key", "driver": "driver_key",
         "route": "route_key", "customer": "customer_key"}
    k.update(keys or {})
    pct = lambda cond: C.round2(F.avg(F.when(cond, 1.0).otherwise(0.0)) * 100).cast("decimal(10,2)")
    aggs = [
        F.count(k["delivery"]).alias("total_deliveries"),
        F.count(k["vehicle"]).alias("total_vehicles"),
        F.count(k["driver"]).alias("total_drivers"),
        F.count(k["route"]).alias("total_routes"),
        F.count(k["customer"]).alias("total_customers"),
        C.dsum("package_weight_kg").alias("total_package_weight_kg"),
        C.dsum("distance_km").alias("total_distance_km"),
        C.dsum("fuel_consumed_liters").alias("total_fuel_consumed_liters"),
        F.round(F.avg("delivery_time_minutes"), 0).cast("int").alias("avg_delivery_time_minutes"),
        F.round(F.avg("delay_minutes"), 0).cast("int").alias("avg_delay_minutes"),
        C.round2(F.avg("deliveries_per_hour")).cast("decimal(10,2)").alias("avg_deliveries_per_hour"),
        C.round2(F.avg("fuel_efficiency_km_per_liter")).cast("decimal(10,2)")
        .alias("avg_fuel_efficiency_km_per_liter"),
        C.dsum("cost_per_delivery").alias("total_cost_per_delivery"),
        C.dsum("revenue_per_delivery").alias("total_revenue_per_delivery"),
        pct(F.col("is_on_time")).alias("on_time_porcentaje"),
        pct(F.col("delivery_status") == "delivered").alias("delivery_status_porcentaje"),
        pct(F.col("is_damaged")).alias("is_damage_porcentaje"),
    ]
    upd = (F.current_date() if date_update is None else F.lit(date_update).cast("date"))
    head = [upd.alias("date_update"), F.lit(str(batch_id)).alias("etl_batch_id")]
    if date_key is not None:
        fact = fact.where(F.col("date_key") == date_key)
    sums = fact.groupBy("date_key").agg(*aggs)
    if date_key is not None:  # one row also for an empty day
        sums = fact.agg(*aggs).select(F.lit(date_key).alias("date_key"), "*")
    # exact distincts: the distinct (day, key) pairs of each key, counted by day
    for name in ("vehicle", "driver", "route", "customer"):
        n = (fact.groupBy("date_key", k[name]).agg(F.lit(1).alias("_"))
             .groupBy("date_key").agg(F.count(k[name]).alias(f"total_{name}s_distinct")))
        sums = sums.join(n, "date_key", "left").withColumn(
            f"total_{name}s_distinct", F.coalesce(f"total_{name}s_distinct", F.lit(0)))
    counts = [f"total_{x}" for x in ("deliveries", "vehicles", "drivers", "routes", "customers")]
    distinct = [f"{c}_distinct" for c in counts[1:]]
    rest = [c for c in sums.columns if c not in ("date_key", *counts, *distinct)]
    return sums.select(*head, "date_key", *counts, *distinct, *rest)


# Mergeable state of a day: any disjoint sets of facts add up to the same totals.
_DAY_SUMS = {"weight": "package_weight_kg", "km": "distance_km", "fuel": "fuel_consumed_liters",
             "per_hour": "deliveries_per_hour", "efficiency": "fuel_efficiency_km_per_liter",
             "cost": "cost_per_delivery", "revenue": "revenue_per_delivery"}
_DAY_MINUTES = {"time": "delivery_time_minutes", "delay": "delay_minutes"}
_DAY_FLAGS = {"on_time": "is_on_time", "delivered": "delivery_status = 'delivered'", "damaged": "is_damaged"}


def day_parts(facts: DataFrame, *by: str) -> DataFrame:
    """Sums and counts of each day."""
    sums = [C.dsum(c).alias(k) for k, c in _DAY_SUMS.items()] + [F.sum(c).alias(k) for k, c in _DAY_MINUTES.items()]
    seen = [F.count(c).alias(f"n_{k}") for k, c in (_DAY_SUMS | _DAY_MINUTES).items()]
    flags = [F.count_if(F.expr(c)).alias(k) for k, c in _DAY_FLAGS.items()]
    return facts.groupBy(*by, "date_key").agg(F.count(F.lit(1)).alias("n"), F.count("customer_name").alias("named"), *sums, *seen, *flags)


def day_keys(facts: DataFrame, *by: str) -> DataFrame:
    """Bitmaps of the serial numbers that each day has seen."""
    ids = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_id").cast("long").alias("id"))
                              for k in ("vehicle", "driver", "route")])).alias("k")
    return key_blocks(facts.select(*by, "date_key", ids).select(*by, "date_key", "k.*"), "id", *by, "date_key", "kind")


def day_customers(facts: DataFrame, *by: str) -> DataFrame:
    """Customers of each day (names have no serial numbers)."""
    return facts.where(F.col("customer_name").isNotNull()).select(*by, "date_key", "customer_name").distinct()


def totals_of(parts: DataFrame, keys: DataFrame, customers: DataFrame) -> DataFrame:
    """The rows of :func:`daily_totals` (natural keys, without its first two columns)
    out of the day states of any disjoint facts."""
    cols = [c for c in parts.columns if c not in ("date_key", "file")]
    day = parts.groupBy("date_key").agg(*[F.sum(c).alias(c) for c in cols])
    bits = keys.groupBy("date_key", "kind", "block").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    distinct = bits.groupBy("date_key").agg(*[
        F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(F.lit(0).cast("bigint"))).alias(f"total_{k}s_distinct")
        for k in ("vehicle", "driver", "route")])
    named = customers.select("date_key", "customer_name").distinct().groupBy("date_key").agg(F.count(F.lit(1)).alias("total_customers_distinct"))
    day = day.join(distinct, "date_key", "left").join(named, "date_key", "left")

    def mean(c):  # of two-digit decimals, to six digits as their average
        return C.round2((F.col(c) / F.col(f"n_{c}")).cast("decimal(38,6)")).cast("decimal(10,2)")

    def minutes(c):
        return F.round(F.col(c).cast("double") / F.col(f"n_{c}"), 0).cast("int")

    def share(c):
        return C.round2(F.col(c).cast("double") / F.col("n") * 100).cast("decimal(10,2)")

    def some(c):  # try_divide: no values, no average
        return F.when(F.col(f"n_{c}") > 0, mean(c) if c in _DAY_SUMS else minutes(c))

    return day.select(
        "date_key", F.col("n").alias("total_deliveries"), F.col("n").alias("total_vehicles"), F.col("n").alias("total_drivers"),
        F.col("n").alias("total_routes"), F.col("named").alias("total_customers"),
        *[F.coalesce(f"total_{k}s_distinct", F.lit(0).cast("bigint")).alias(f"total_{k}s_distinct")
          for k in ("vehicle", "driver", "route", "customer")],
        F.col("weight").alias("total_package_weight_kg"), F.col("km").alias("total_distance_km"),
        F.col("fuel").alias("total_fuel_consumed_liters"),
        some("time").alias("avg_delivery_time_minutes"), some("delay").alias("avg_delay_minutes"),
        some("per_hour").alias("avg_deliveries_per_hour"), some("efficiency").alias("avg_fuel_efficiency_km_per_liter"),
        F.col("cost").alias("total_cost_per_delivery"), F.col("revenue").alias("total_revenue_per_delivery"),
        share("on_time").alias("on_time_porcentaje"), share("delivered").alias("delivery_status_porcentaje"),
        share("damaged").alias("is_damage_porcentaje"))


# Role views ----------------------------------------------------------------
def v_sales(fact: DataFrame, dim_date_df: DataFrame, customers: DataFrame) -> DataFrame:
    return (fact.join(dim_date_df.select("date_key", "full_date"), "date_key")
            .join(customers.select("customer_key", "customer_name", "customer_type"), "customer_key")
            .where(F.col("customer_type") != EXCLUDED_SALES_CUSTOMER_TYPE)
            .select("full_date", "customer_name", "customer_type", "package_weight_kg",
                    "delivery_status", "revenue_per_delivery"))


def v_operations(fact: DataFrame, dim_date_df: DataFrame, dim_time_df: DataFrame,
                 dim_vehicle: DataFrame, dim_driver: DataFrame, routes: DataFrame,
                 customers: DataFrame) -> DataFrame:
    # dim_time has 1440 rows by construction: a bounded broadcast.
    t = F.broadcast(dim_time_df.select(F.col("time_key").alias("scheduled_time_key"),
                                       F.col("hour_24").alias("hora")))
    return (fact.join(dim_date_df.select("date_key", "full_date"), "date_key")
            .join(t, "scheduled_time_key")
            .join(dim_vehicle.select("vehicle_key", "license_plate"), "vehicle_key")
            .join(dim_driver.select("driver_key", F.col("full_name").alias("conductor")), "driver_key")
            .join(routes.select("route_key", "route_code"), "route_key")
            .join(customers.select("customer_key", "customer_name"), "customer_key")
            .select("full_date", "hora", "license_plate", "conductor", "route_code",
                    "customer_name", "delivery_time_minutes", "delay_minutes", "is_on_time",
                    "fuel_consumed_liters"))


# One batch in memory ------------------------------------------------------
@dataclass
class Warehouse:
    measured: DataFrame       # every extracted row, measures and reject reason
    facts: DataFrame          # typed fact rows with natural ids
    rejected: DataFrame
    dim_vehicle: DataFrame
    dim_driver: DataFrame
    dim_route: DataFrame
    dim_customer: DataFrame
    dim_date: DataFrame
    dim_time: DataFrame
    fact_deliveries: DataFrame


def build(spark: SparkSession, fleet: Fleet, as_of, batch_id: int = 1,
          start=None, end=None, last_day: bool = True, etl_ts=None) -> Warehouse:
    """Plan one initial batch in memory.

    The fact rows feed five consumers (keys, customers, ratings, calendar
    span, first date) and are written once. Stored batches are the work of
    :func:`convoy.plans.batches.run_daily`.
    """
    m = measured(extract(fleet, start, end, last_day))
    acc, rej = split_measured(m)
    facts = materialize(fact_rows(acc))
    dv, dd = next_versions(None, None, vehicle_snapshot(fleet, as_of), driver_snapshot(fleet, as_of, on_time_rates(facts)),
                           batch_date(as_of))
    dr = dim_route(fleet)
    return Warehouse(m, facts, rej, dv, dd, dr, customer_rows(facts), dim_date_from(facts), dim_time(spark),
                     keyed_facts(facts, dv, dd, dr, batch_id, etl_ts))


def batch_date(as_of):
    return F.to_date(F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of)


def next_versions(vehicles: DataFrame | None, drivers: DataFrame | None, vehicle_rows: DataFrame, driver_rows: DataFrame,
                  day) -> tuple[DataFrame, DataFrame]:
    """Both type-2 dimensions after one batch's snapshots (``None``: initial load)."""
    # The initial load opens every version at the beginning of time, so that a
    # fact finds one however late (and from however far back) it arrives.
    start = F.lit(INITIAL_VALID_FROM).cast("date") if vehicles is None and drivers is None else day
    dv = scd2_apply(vehicles, vehicle_rows, "vehicle_id",
                    ["license_plate", "vehicle_type", "capacity_kg", "fuel_type", "status"],
                    start, "vehicle_key", type1=["age_months", "last_maintenance_date"])
    # The rating is derived from the facts: overwritten in the current version
    # (type 1) instead of opening a version per batch.
    dd = scd2_apply(drivers, driver_rows, "driver_id",
                    ["employee_code", "full_name", "license_number", "license_expiry", "phone", "status"],
                    start, "driver_key", type1=["performance_category", "experience_months"])
    return dv, rated(dd)
