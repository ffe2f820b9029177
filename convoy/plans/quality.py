"""Data-quality reports over the fleet tables.

* :func:`validation_checks` - the five load validations (orphans, time order,
  overweight trips, missing tracking numbers) with an all-valid flag;
* :func:`constraint_audit` - every declared key / not-null / foreign-key /
  default constraint of the fleet schema, checked against the data;
* :func:`table_counts`, :func:`trip_delivery_stats`, :func:`summary_json` -
  the load summary;
* :func:`table_inventory` - column count per table from the schemas.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convoy.operators.audit import Rule, audit, orphan_count
from convoy.sources.fleet import Fleet

# The constraints declared by the source schema.
FLEET_RULES: list[Rule] = [
    Rule("primary_key", "vehicles", "vehicle_id"),
    Rule("unique", "vehicles", "license_plate"),
    Rule("not_null", "vehicles", "license_plate"),
    Rule("not_null", "vehicles", "vehicle_type"),
    Rule("default", "vehicles", "status", default="active"),
    Rule("primary_key", "drivers", "driver_id"),
    Rule("unique", "drivers", "employee_code"),
    Rule("not_null", "drivers", "employee_code"),
    Rule("not_null", "drivers", "first_name"),
    Rule("not_null", "drivers", "last_name"),
    Rule("unique", "drivers", "license_number"),
    Rule("not_null", "drivers", "license_number"),
    Rule("default", "drivers", "status", default="active"),
    Rule("primary_key", "routes", "route_id"),
    Rule("unique", "routes", "route_code"),
    Rule("not_null", "routes", "route_code"),
    Rule("not_null", "routes", "origin_city"),
    Rule("not_null", "routes", "destination_city"),
    Rule("default", "routes", "toll_cost", default=0),
    Rule("primary_key", "trips", "trip_id"),
    Rule("foreign_key", "trips", "vehicle_id", "vehicles", "vehicle_id"),
    Rule("foreign_key", "trips", "driver_id", "drivers", "driver_id"),
    Rule("foreign_key", "trips", "route_id", "routes", "route_id"),
    Rule("not_null", "trips", "departure_datetime"),
    Rule("default", "trips", "status", default="in_progress"),
    Rule("primary_key", "deliveries", "delivery_id"),
    Rule("foreign_key", "deliveries", "trip_id", "trips", "trip_id"),
    Rule("unique", "deliveries", "tracking_number"),
    Rule("not_null", "deliveries", "tracking_number"),
    Rule("not_null", "deliveries", "customer_name"),
    Rule("not_null", "deliveries", "delivery_address"),
    Rule("default", "deliveries", "delivery_status", default="pending"),
    Rule("default", "deliveries", "recipient_signature", default=False),
    Rule("primary_key", "maintenance", "maintenance_id"),
    Rule("foreign_key", "maintenance", "vehicle_id", "vehicles", "vehicle_id"),
    Rule("not_null", "maintenance", "maintenance_date"),
    Rule("not_null", "maintenance", "maintenance_type"),
    Rule("max_length", "vehicles", "license_plate", length=20),
    Rule("max_length", "vehicles", "vehicle_type", length=50),
    Rule("max_length", "vehicles", "fuel_type", length=20),
    Rule("max_length", "vehicles", "status", length=20),
    Rule("max_length", "drivers", "employee_code", length=20),
    Rule("max_length", "drivers", "first_name", length=100),
    Rule("max_length", "drivers", "last_name", length=100),
    Rule("max_length", "drivers", "license_number", length=50),
    Rule("max_length", "drivers", "phone", length=20),
    Rule("max_length", "drivers", "status", length=20),
    Rule("max_length", "routes", "route_code", length=20),
    Rule("max_length", "routes", "origin_city", length=100),
    Rule("max_length", "routes", "destination_city", length=100),
    Rule("max_length", "trips", "status", length=20),
    Rule("max_length", "deliveries", "tracking_number", length=50),
    Rule("max_length", "deliveries", "customer_name", length=200),
    Rule("max_length", "deliveries", "delivery_status", length=20),
    Rule("max_length", "maintenance", "maintenance_type", length=50),
]


def _one(name: str, bad: DataFrame) -> DataFrame:
    return bad.agg(F.count(F.lit(1)).alias("bad_rows")) \
        .select(F.lit(name).alias("check_name"), "bad_rows")


def _named(name: str, v: DataFrame) -> DataFrame:
    return v.select(F.lit(name).alias("check_name"), F.col("v").cast("bigint").alias("bad_rows"))


def validation_checks(fleet: Fleet) -> DataFrame:
    t, v, d = fleet.trips, fleet.vehicles, fleet.deliveries
    # Trips per (vehicle, weight): only these counts meet the vehicles.
    per_weight = t.groupBy("vehicle_id", "total_weight_kg").agg(F.count(F.lit(1)).alias("_n"))
    over = (per_weight.join(v.select("vehicle_id", "capacity_kg"), "vehicle_id")
            .where(F.col("total_weight_kg") > F.col("capacity_kg"))
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("v")))
    checks = [
        # a trip whose vehicle is missing (NULL vehicle ids count as missing)
        _named("trips_without_vehicle",
               orphan_count(t, "vehicle_id", v, "vehicle_id", null_is_orphan=True)),
        _named("deliveries_without_trip",
               orphan_count(d, "trip_id", t, "trip_id", null_is_orphan=True)),
        _one("trips_arrival_before_departure",
             t.where(F.col("arrival_datetime").isNotNull()
                     & (F.col("arrival_datetime") < F.col("departure_datetime")))),
        _named("trips_over_capacity", over),
        _one("deliveries_without_tracking_number",
             d.where(F.col("tracking_number").isNull() | (F.col("tracking_number") == ""))),
    ]
    out = reduce(DataFrame.unionByName, checks).withColumn("ok", F.col("bad_rows") == 0)
    # Five rows: the all-valid flag is a bounded window over them.
    return out.withColumn("all_valid", F.min(F.col("ok").cast("int")).over(Window.partitionBy())
                          .cast("boolean"))


def constraint_audit(fleet: Fleet, rules: list[Rule] | None = None) -> DataFrame:
    return audit(dict(fleet.items()), rules or FLEET_RULES)


def table_counts(fleet: Fleet) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in fleet.items()]
    return reduce(DataFrame.unionByName, parts)


def trip_delivery_stats(fleet: Fleet) -> DataFrame:
    per_trip = fleet.deliveries.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n"))
    return per_trip.agg(F.avg("n").alias("avg_deliveries_per_trip"),
                        F.min("n").alias("min_deliveries"),
                        F.max("n").alias("max_deliveries"))


def summary_json(fleet: Fleet, generated_at=None) -> DataFrame:
    """One row, one JSON column: generation time, total, per-table counts,
    per-trip delivery stats and whether every validation passed."""
    counts = table_counts(fleet).agg(
        F.sum("row_count").alias("total_records"),
        # entries sorted by table name: the JSON text is reproducible
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("table_name", "row_count"))))
        .alias("table_counts"))
    valid = validation_checks(fleet).agg(F.bool_and("ok").alias("validations_passed"))
    stats = trip_delivery_stats(fleet)
    ts = F.lit(generated_at).cast("timestamp_ntz") if generated_at else F.localtimestamp()
    # The validation flag and the per-trip stats are single-row aggregates,
    # attached as scalar subqueries.
    body = counts.select(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("generation_date"),
        "total_records", "table_counts",
        valid.select("validations_passed").scalar().alias("validations_passed"),
        stats.select("avg_deliveries_per_trip").scalar().alias("avg_deliveries_per_trip"),
        stats.select("min_deliveries").scalar().alias("min_deliveries"),
        stats.select("max_deliveries").scalar().alias("max_deliveries"))
    return body.select(F.to_json(F.struct(*body.columns)).alias("summary"))


def table_inventory(spark: SparkSession, fleet: Fleet, like: str | None = None) -> DataFrame:
    """Column count per table, ordered by table name (schema metadata only);
    ``like`` keeps the table names matching an SQL LIKE pattern."""
    rows = [(name, len(df.columns)) for name, df in fleet.items()]
    out = spark.createDataFrame(rows, "table_name string, column_count int")
    if like is not None:
        out = out.where(F.col("table_name").like(like))
    return out.orderBy("table_name")
