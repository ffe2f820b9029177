"""Deterministic data work of the source's data generator, re-aimed at
existing tables: vehicle operating spans, maintenance and stop schedules,
weight allocation and the city-pair route table.

Random choices of the source (types, noise, speeds) are replaced by rules,
so every output is a pure function of the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.functions import columns as C
from convoy.operators.expand import allocate, expand_range
from convoy.operators.prefix import row_numbers
from convoy.plans.warehouse import pd_round
from convoy.sources.fleet import Fleet

# Maintenance types with base cost and days to the next service.
MAINTENANCE_TYPES = [
    ("Cambio de aceite", 150000, 30),
    ("Revisión de frenos", 250000, 60),
    ("Cambio de llantas", 450000, 90),
    ("Mantenimiento general", 350000, 45),
    ("Revisión de motor", 500000, 60),
    ("Alineación y balanceo", 180000, 30),
]
TRIPS_PER_SERVICE = 20          # one service per 20 trips, at least one
STOP_HOURS_WITHOUT_ARRIVAL = 0.5
WEIGHT_LOAD_FACTOR = 0.95
MIN_PACKAGE_KG = 0.5
DEFAULT_PAIR_KM = 500
TOLL_PER_100_KM = 15000
ROUTE_AVG_SPEED_KMH = 70        # midpoint of the source's 60-80 km/h range


# R1 ---------------------------------------------------------------------
def vehicle_span_as_written(fleet: Fleet) -> DataFrame:
    """Trip count, first departure and 'last trip' per vehicle, as the source
    query computes them: its last_value() keeps the default frame, which ends
    at the current row's peers, so 'last trip' is each trip's own arrival and
    DISTINCT returns one row per (vehicle, arrival).

    Computed with aggregates instead of windows: per-vehicle count and first
    departure joined to the distinct (vehicle, arrival) pairs.
    """
    vt = fleet.vehicles.select("vehicle_id", "vehicle_type")
    t = fleet.trips.select("vehicle_id", "trip_id", "departure_datetime", "arrival_datetime")
    # Trips are reduced per vehicle (and per distinct arrival) before the
    # vehicle type is joined: the inner join on vehicle_id commutes with
    # grouping by vehicle_id.
    per_vehicle = t.groupBy("vehicle_id").agg(
        F.count("trip_id").alias("trip_count"), F.min("departure_datetime").alias("first_trip")) \
        .join(vt, "vehicle_id")
    arrivals = t.select("vehicle_id", F.col("arrival_datetime").alias("last_trip")).distinct()
    return (arrivals.join(per_vehicle, "vehicle_id")
            .select("vehicle_id", "vehicle_type", "trip_count", "first_trip", "last_trip")
            .orderBy("vehicle_id", F.col("last_trip").desc_nulls_first()))


def vehicle_span(fleet: Fleet) -> DataFrame:
    """One row per vehicle: trip count, first departure, last arrival."""
    vt = fleet.vehicles.select("vehicle_id", "vehicle_type")
    per_vehicle = fleet.trips.groupBy("vehicle_id").agg(
        F.count("trip_id").alias("trip_count"),
        F.min("departure_datetime").alias("first_trip"),
        F.max("arrival_datetime").alias("last_trip"))
    return vt.join(per_vehicle, "vehicle_id").orderBy("vehicle_id")


# R2 ---------------------------------------------------------------------
def maintenance_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, n, c, d) for i, (n, c, d) in enumerate(MAINTENANCE_TYPES)],
        "type_idx int, maintenance_type string, base_cost int, days_to_next int")


def maintenance_schedule(spark: SparkSession, fleet: Fleet, max_records: int | None = None
                         ) -> DataFrame:
    """Services spread evenly over each vehicle's operating span.

    ``n = max(1, trips div 20)``; service ``i`` (0-based) falls
    ``floor(days * (i + 1) / (n + 1))`` days after the first departure, where
    ``days`` is the whole days between first departure and last arrival.
    Type ``(vehicle_id + i) mod 6`` of the type table; next service after the
    type's lead days. Vehicles without an arrival get none.
    """
    span = vehicle_span(fleet).where(F.col("first_trip").isNotNull()
                                     & F.col("last_trip").isNotNull())
    n = F.greatest(F.lit(1), F.floor(F.col("trip_count") / TRIPS_PER_SERVICE).cast("bigint"))
    days = F.floor(F.timestamp_diff("SECOND", F.col("first_trip"), F.col("last_trip")) / 86400)
    base = span.select("vehicle_id", "vehicle_type", "first_trip",
                       n.alias("n"), days.cast("bigint").alias("operation_days"))
    rows = expand_range(base, "n", "i", keys=["vehicle_id"])
    offset = F.floor(F.col("operation_days") * (F.col("i") + 1) / (F.col("n") + 1)).cast("int")
    mdate = F.to_date(F.col("first_trip") + F.make_dt_interval(days=offset))
    types = F.broadcast(maintenance_types(spark))
    out = (rows.withColumn("maintenance_date", mdate)
           .withColumn("type_idx", ((F.col("vehicle_id") + F.col("i")) % len(MAINTENANCE_TYPES)).cast("int"))
           .join(types, "type_idx")
           .select("vehicle_id", F.col("i").alias("service_number"), "maintenance_date",
                   "maintenance_type",
                   F.concat(F.col("maintenance_type"), F.lit(" programado para "),
                            F.date_format("maintenance_date", "yyyy-MM-dd")).alias("description"),
                   F.col("base_cost").cast("decimal(10,2)").alias("cost"),
                   F.date_add("maintenance_date", F.col("days_to_next")).alias("next_maintenance_date")))
    if max_records is not None:
        out = out.orderBy("vehicle_id", "service_number").limit(max_records)
    return out


# R3 ---------------------------------------------------------------------
def stop_schedule(fleet: Fleet) -> DataFrame:
    """Planned time of each stop of a trip: the trip's duration split evenly
    over its deliveries, stop ``i`` at the middle of its slot; half an hour
    per stop while the trip has no arrival."""
    per_trip = fleet.deliveries.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n_stops"))
    t = fleet.trips.select("trip_id", "departure_datetime", "arrival_datetime").join(per_trip, "trip_id")
    rows = expand_range(t, "n_stops", "stop_index", keys=["trip_id"])
    secs = F.timestamp_diff("SECOND", F.col("departure_datetime"), F.col("arrival_datetime"))
    slot_s = F.when(F.col("arrival_datetime").isNull(), F.lit(STOP_HOURS_WITHOUT_ARRIVAL * 3600.0)) \
        .otherwise(secs.cast("double") / F.col("n_stops").cast("double"))
    offset_us = F.round(slot_s * (F.col("stop_index") + F.lit(0.5)) * F.lit(1e6)).cast("bigint")
    planned = F.timestamp_add("MICROSECOND", offset_us, F.col("departure_datetime"))
    return rows.select("trip_id", "stop_index", "n_stops", planned.alias("planned_datetime"))


# R4 ---------------------------------------------------------------------
def weight_allocation(fleet: Fleet) -> DataFrame:
    """Trip load split over its packages in proportion to their weight,
    95 % of the trip weight, at least 0.5 kg each, rounded to 2 places."""
    d = fleet.deliveries.select("delivery_id", "trip_id", "package_weight_kg")
    t = fleet.trips.select("trip_id", "total_weight_kg")
    x = allocate(d.join(t, "trip_id"), ["trip_id"], "package_weight_kg", "total_weight_kg",
                 "allocated_kg", factor=WEIGHT_LOAD_FACTOR, floor=MIN_PACKAGE_KG)
    return x.select("delivery_id", "trip_id", "package_weight_kg", "total_weight_kg",
                    pd_round(F.col("allocated_kg")).alias("allocated_kg"))


# R5 ---------------------------------------------------------------------
def route_table(fleet: Fleet, hub: str | None = None, count: int | None = None) -> DataFrame:
    """Routes between every ordered pair of distinct cities: 3 variants when
    either end is the hub city, else 2; distance from the unordered-pair
    lookup (default 500 km), toll 15000 per whole 100 km, duration at
    70 km/h, codes R001, R002 ... in (origin, destination, variant) order.

    Cities are the distinct route endpoints; the hub defaults to the first
    city in name order. Cities and routes are numbered over range partitions.
    """
    cities = fleet.routes.select(F.col("origin_city").alias("city")) \
        .union(fleet.routes.select(F.col("destination_city").alias("city"))).distinct()
    hub_city = F.lit(hub) if hub else cities.select(F.min("city")).scalar()
    # ordered pairs via an equi-join on a city index: each origin lists the
    # other cities by position (no nested-loop pair enumeration)
    idx = row_numbers(cities, [F.col("city")], "ci").withColumn("ci", F.col("ci") - 1)
    n = idx.select(F.count(F.lit(1))).scalar()
    origins = idx.select(F.col("city").alias("origin_city"), F.col("ci").alias("oi"),
                         F.explode(F.sequence(F.lit(1), (n - 1).cast("int"))).alias("step"))
    origins = origins.withColumn("di", (F.col("oi") + F.col("step")) % n)
    pairs = origins.join(idx.select(F.col("ci").alias("di"), F.col("city").alias("destination_city")), "di")
    lookup = (fleet.routes.where(F.col("origin_city") != F.col("destination_city"))
              .groupBy(F.least("origin_city", "destination_city").alias("a"),
                       F.greatest("origin_city", "destination_city").alias("b"))
              .agg(F.min("distance_km").alias("base_km")))
    variants = F.when((F.col("origin_city") == hub_city) | (F.col("destination_city") == hub_city), 3) \
        .otherwise(2)
    pairs = (pairs.withColumn("a", F.least("origin_city", "destination_city"))
             .withColumn("b", F.greatest("origin_city", "destination_city"))
             .join(lookup, ["a", "b"], "left")
             .withColumn("variant", F.explode(F.sequence(F.lit(0), variants - 1))))
    km = F.coalesce(F.col("base_km"), F.lit(DEFAULT_PAIR_KM).cast("decimal(10,2)"))
    pairs = row_numbers(pairs, [F.col("origin_city"), F.col("destination_city"), F.col("variant")], "number")
    if count is not None:  # the first ``count`` numbers, in order of the number
        pairs = pairs.where(F.col("number") <= count)
    return pairs.select(
        C.zero_pad_code("R", F.col("number"), 3).alias("route_code"),
        "origin_city", "destination_city", km.cast("decimal(10,2)").alias("distance_km"),
        C.round2(km.cast("double") / F.lit(float(ROUTE_AVG_SPEED_KMH))).cast("decimal(5,2)")
        .alias("estimated_duration_hours"),
        (F.floor(km / 100) * F.lit(TOLL_PER_100_KM)).cast("decimal(10,2)").alias("toll_cost"))
