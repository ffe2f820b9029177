"""Registered event queries: the handlers over the full event table, and an
end-to-end streaming run whose sink is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.operators.nearest import cell_index
from convoy.session import checkpoint_dir
from convoy.sources import events as EV
from convoy.sources.fleet import cached_fleet
from convoy.streaming import handlers as H
from convoy.streaming import jobs as J
from convoy.streaming.keyed_table import KeyedTable


def flat_points(df: DataFrame) -> DataFrame:
    """Point structs as plain columns (``current_location`` ->
    ``current_location_lat``, ``current_location_lon``), so results compare
    cell by cell with any engine."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "struct" and {x.name for x in f.dataType.fields} == {"lat", "lon"}:
            cols += [df[f.name]["lat"].alias(f"{f.name}_lat"), df[f.name]["lon"].alias(f"{f.name}_lon")]
        else:
            cols.append(df[f.name])
    return df.select(*cols)


def verify_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = EV.delivery_status(cached_fleet(spark, sf_dir))
    return H.verify_deliveries(EV.delivery_marks(spark, sf_dir), status).drop("body")


def vehicle_eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_points(H.vehicle_eta(EV.gps_pings(spark, sf_dir)))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.route_deviation(EV.gps_pings(spark, sf_dir), EV.route_waypoints(spark, sf_dir))


def route_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_points(_checked(spark, sf_dir))


def deviation_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_points(H.deviation_alerts(_checked(spark, sf_dir)))


def stop_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviation of every ping from the customer stops of its route, by the cell index."""
    return flat_points(H.route_deviation(EV.stop_pings(spark, sf_dir), cell_index(EV.stop_waypoints(spark, sf_dir))))


def stream_stop_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a stream of pings against a stored cell index."""
    base = _base(spark)
    EV.write_event_files(EV.stop_pings(spark, sf_dir), f"{base}/pings")
    cell_index(EV.stop_waypoints(spark, sf_dir)).write.parquet(f"{base}/index")
    J.route_deviation_alerts(EV.read_event_stream(spark, f"{base}/pings", "gps", max_files_per_trigger=2),
                             spark.read.parquet(f"{base}/index"), f"{base}/alerts", f"{base}/messages",
                             f"{base}/_checkpoint", trigger="availableNow").awaitTermination()
    return flat_points(spark.read.parquet(f"{base}/alerts").drop("batch_id", "event_id"))


def _parsed(bodies: DataFrame, fields: str) -> DataFrame:
    """JSON answers as columns, so that they compare value by value."""
    return bodies.select("event_id", F.from_json("body", f"{fields}, error string").alias("b")).select("event_id", "b.*")


def verify_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = EV.delivery_status(cached_fleet(spark, sf_dir))
    return _parsed(H.verify_deliveries(EV.delivery_marks(spark, sf_dir), status),
                   "delivery_id bigint, tracking_number string, is_completed boolean, status string, delivered_datetime string")


def eta_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(H.eta_body(H.vehicle_eta(EV.gps_pings(spark, sf_dir))),
                   "vehicle_id bigint, distance_remaining_km double, eta string, estimated_minutes bigint")


def deviation_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(H.deviation_body(_checked(spark, sf_dir)),
                   "vehicle_id bigint, is_deviated boolean, deviation_km double, alert_sent boolean, threshold_km int")


def stream_deviation_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the pings as files, run the streaming deviation job to the end of
    its input (``availableNow``) and read the alert table back."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/convoy-stream-{uuid.uuid4().hex}"
    EV.write_event_files(EV.gps_pings(spark, sf_dir), f"{base}/pings")
    q = J.route_deviation_alerts(EV.read_event_stream(spark, f"{base}/pings", "gps"),
                                 EV.route_waypoints(spark, sf_dir), f"{base}/alerts",
                                 f"{base}/messages", f"{base}/_checkpoint",
                                 trigger="availableNow")
    q.awaitTermination()
    return flat_points(spark.read.parquet(f"{base}/alerts").drop("batch_id", "event_id"))


def stream_delivery_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the marks as files and run the verification stream over them."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/convoy-stream-{uuid.uuid4().hex}"
    EV.write_event_files(EV.delivery_marks(spark, sf_dir), f"{base}/marks")
    status = EV.delivery_status(cached_fleet(spark, sf_dir))
    J.delivery_verification(EV.read_event_stream(spark, f"{base}/marks", "marks"), status, f"{base}/out",
                            f"{base}/_checkpoint", trigger="availableNow").awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("body")


def stream_vehicle_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the pings and, once more, a retry of all of them; run the tracking
    stream and read its table by key: one row for each vehicle and time."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/convoy-stream-{uuid.uuid4().hex}"
    for _ in range(2):
        EV.write_event_files(EV.gps_pings(spark, sf_dir), f"{base}/pings")
    J.vehicle_tracking(EV.read_event_stream(spark, f"{base}/pings", "gps", max_files_per_trigger=4), f"{base}/out",
                       f"{base}/_checkpoint", trigger="availableNow", latest_only=False).awaitTermination()
    return flat_points(J.read_keyed(spark, f"{base}/out", ["vehicle_id", "ts"]))


def latest_ping_per_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from convoy.sources.sinks import latest_per_vehicle
    return flat_points(latest_per_vehicle(EV.gps_pings(spark, sf_dir)))


def _base(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/convoy-stream-{uuid.uuid4().hex}"


def stream_newest_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest ping of each vehicle out of a stream that brings pings in any order, a micro-batch
    a file, into a table compacted on the way."""
    base = _base(spark)
    EV.write_event_files(EV.gps_pings(spark, sf_dir), f"{base}/pings", files=12)
    table = KeyedTable(spark, f"{base}/table", ["vehicle_id"], ["ts", "event_id"], buckets=4)
    J.newest_positions(EV.read_event_stream(spark, f"{base}/pings", "gps", max_files_per_trigger=1), table, f"{base}/_checkpoint",
                       trigger="availableNow", compact_every=5).awaitTermination()
    return flat_points(table.read().drop("batch_id"))


def stream_tracking_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ETA of each vehicle and time (highest event id) from a compacted table."""
    base = _base(spark)
    EV.write_event_files(EV.gps_pings(spark, sf_dir), f"{base}/pings", files=12)
    table = KeyedTable(spark, f"{base}/table", ["vehicle_id", "ts"], ["event_id"], buckets=4)
    J.tracking_table(EV.read_event_stream(spark, f"{base}/pings", "gps", max_files_per_trigger=1), table, f"{base}/_checkpoint",
                     trigger="availableNow", compact_every=5).awaitTermination()
    return flat_points(table.read().drop("batch_id"))


#: Rows of a bucket of the status table.
STATUS_ROWS = 200_000


def bucket_width(rows: DataFrame, key: str) -> int:
    """Width of the ranges of ``key`` that hold about ``STATUS_ROWS`` rows each, so that
    buckets, and with them files, grow with the rows and not with the span of the ids."""
    r = rows.agg(F.count(key).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    return max(1, (r.hi - r.lo + 1) * STATUS_ROWS // r.n) if r.n else STATUS_ROWS


def stream_keyed_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verification against a keyed status table whose statuses have come in two writes:
    every third delivery as under way first, then as it is."""
    base = _base(spark)
    EV.write_event_files(EV.delivery_marks(spark, sf_dir), f"{base}/marks")
    status = EV.delivery_status(cached_fleet(spark, sf_dir))
    third = F.col("delivery_id") % 3 == 0
    table = KeyedTable(spark, f"{base}/status", ["delivery_id"], ["batch_id"], bucket=f"delivery_id div {bucket_width(status, 'delivery_id')}")
    table.put(status.withColumn("status", F.when(third, "in_transit").otherwise(F.col("status"))), 0)
    table.compact()
    table.put(status.where(third), 1)
    J.keyed_verification(EV.read_event_stream(spark, f"{base}/marks", "marks", max_files_per_trigger=2), table, f"{base}/out",
                         f"{base}/_checkpoint", trigger="availableNow").awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("body", "batch_id")


def stream_alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert messages published from the outbox of a stream, while it runs and after."""
    base = _base(spark)
    pings = EV.gps_pings(spark, sf_dir)
    for part in range(2):
        EV.write_event_files(pings.where(F.col("event_id") % 2 == part), f"{base}/pings", files=2)
        J.route_deviation_alerts(EV.read_event_stream(spark, f"{base}/pings", "gps", max_files_per_trigger=1),
                                 EV.route_waypoints(spark, sf_dir), f"{base}/alerts", f"{base}/messages", f"{base}/_checkpoint",
                                 trigger="availableNow").awaitTermination()
        J.publish_messages(spark, f"{base}/messages", f"{base}/published")
    got = spark.read.parquet(f"{base}/published/messages")
    fields = ("vehicle_id bigint, driver_id bigint, route_id bigint, deviation_km double, "
              "current_location struct<lat: double, lon: double>, timestamp string, alert_type string")
    return flat_points(got.select(F.col("key").alias("message_key"), F.from_json("value", fields).alias("m")).select("message_key", "m.*"))
