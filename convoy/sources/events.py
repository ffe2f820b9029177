"""Event inputs of the streaming jobs, derived from the driver's ``events``
table, plus the key-value state tables they look up.

* GPS pings: one per event (vehicle, route, position, destination, speed);
* delivery marks: the app's "delivery done" calls (some without an id, some
  for unknown deliveries);
* delivery status: latest status per delivery, from the deliveries table;
* route waypoints: one waypoint list per route id (one list empty; the last
  route id has none, so its pings are "route not found").

:func:`write_event_files` lands pings/marks as parquet files, which a
``readStream`` file source then consumes (a message bus in production).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.sources.fleet import Fleet, read_driver_table
from convoy.sources.schemas import DELIVERY_MARK, GPS_PING, WAYPOINTS

N_GPS_ROUTES = 5          # ping route ids are 0..4
STOPS_A_ROUTE = 400       # customers whose stops make one route
WAYPOINT_ROUTES = 4       # routes 0..3 have a waypoint list (route 3's is empty)


def gps_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_driver_table(spark, sf_dir, "events")
    n_vehicles = read_driver_table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    e, u = F.col("event_id"), F.col("user_id")
    speed = (F.when(e % 11 == 0, F.lit(None).cast("double"))
             .when(e % 13 == 0, F.lit(0.0)).otherwise(F.col("value")))
    return ev.select(
        e.alias("event_id"),
        (u % n_vehicles).alias("vehicle_id"),
        u.alias("driver_id"),
        (u % N_GPS_ROUTES).alias("route_id"),
        F.col("ts"),
        F.struct((F.lit(4.0) + (e % 100) / 100.0).alias("lat"),
                 (F.lit(-74.0) - (e % 70) / 100.0).alias("lon")).alias("current_location"),
        F.struct((F.lit(4.6) + (u % 7) / 10.0).alias("lat"),
                 (F.lit(-74.1) - (u % 5) / 10.0).alias("lon")).alias("destination"),
        speed.alias("current_speed_kmh"))


def delivery_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_driver_table(spark, sf_dir, "events")
    e, u = F.col("event_id"), F.col("user_id")
    did = F.when(e % 17 == 0, F.lit(None).cast("bigint")).otherwise(u * 100 + 1 + e % 3)
    return ev.select(e.alias("event_id"), F.col("ts"), did.alias("delivery_id"),
                     F.concat(F.lit("FL"), did.cast("string")).alias("tracking_number"))


def delivery_status(fleet: Fleet) -> DataFrame:
    return fleet.deliveries.select("delivery_id", "tracking_number",
                                   F.col("delivery_status").alias("status"), "delivered_datetime")


def route_waypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waypoints of routes 0..3 laid along a line from the nation key;
    route 3 has an empty list."""
    nation = read_driver_table(spark, sf_dir, "nation").where(F.col("n_nationkey") < WAYPOINT_ROUTES)
    k = F.col("n_nationkey")
    pts = F.transform(F.sequence(F.lit(0), F.lit(4)),
                      lambda j: F.struct((F.lit(4.0) + k * 0.1 + j * 0.2).alias("lat"),
                                         (F.lit(-74.0) - j * 0.15).alias("lon")))
    empty = F.array().cast(WAYPOINTS["waypoints"].dataType)
    return nation.select(k.cast("bigint").alias("route_id"),
                         F.when(k == WAYPOINT_ROUTES - 1, empty).otherwise(pts).alias("waypoints"))


def stop_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The GPS pings spread over the routes of :func:`stop_waypoints`, number 0 (no
    route) and one number past the last (an unknown route)."""
    last = read_driver_table(spark, sf_dir, "customer").select(F.max("c_custkey")).scalar()
    routes = F.floor(last / F.lit(STOPS_A_ROUTE)) + 3
    return gps_pings(spark, sf_dir).withColumn("route_id", (F.col("event_id") % routes).cast("bigint"))


def stop_waypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes from 1 over customer stops: ``STOPS_A_ROUTE`` consecutive customers each,
    so that routes grow with the customers and no list does."""
    k = F.col("c_custkey").cast("bigint")
    spread = lambda step, of: (k * step % of).cast("double") / F.lit(float(of))
    point = F.struct((F.lit(4.0) + spread(7919, 10007) * 3.0).alias("lat"), (F.lit(-74.0) - spread(104729, 10009)).alias("lon"))
    return (read_driver_table(spark, sf_dir, "customer")
            .groupBy((F.floor(k / F.lit(STOPS_A_ROUTE)) + 1).cast("bigint").alias("route_id"))
            .agg(F.collect_list(point).alias("waypoints")))


def write_event_files(df: DataFrame, path: str, files: int = 4) -> None:
    """Land events as parquet files for a file stream source."""
    df.repartition(files).write.mode("append").parquet(path)


def read_event_stream(spark: SparkSession, path: str, kind: str = "gps",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    schema = {"gps": GPS_PING, "marks": DELIVERY_MARK}[kind]
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)
