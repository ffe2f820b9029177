"""The three event handlers as DataFrame transformations.

Each works on a batch DataFrame and on a streaming DataFrame alike (only
projections and stream-static joins), so the same function backs the batch
queries and the Structured Streaming jobs in :mod:`convoy.streaming.jobs`.

Status codes follow the source: 400 when a required field is missing or
falsy (NULL, 0 or empty), 404 when the looked-up key is unknown, 200
otherwise. The response body is the JSON the source returns; event time
replaces the wall clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.functions import columns as C
from convoy.operators.nearest import nearest_in_cells_km
from convoy.plans.warehouse import pd_round


# Fixed values of the source handlers' responses.
ERROR_MISSING_DELIVERY_ID = "delivery_id es requerido"
ERROR_DELIVERY_NOT_FOUND = "Entrega no encontrada"
ERROR_MISSING_FIELDS = "Faltan parámetros requeridos"
ERROR_ROUTE_NOT_FOUND = "Ruta no encontrada"
NO_ETA = "No disponible"
ALERT_TYPE = "ROUTE_DEVIATION"


def _falsy(c: str) -> F.Column:
    col = F.col(c)
    return col.isNull() | (col == 0)


# I1 ---------------------------------------------------------------------
def verify_deliveries(marks: DataFrame, status: DataFrame) -> DataFrame:
    """Delivery verification: left join of each mark to the status table."""
    s = status.select(F.col("delivery_id").alias("_sid"), F.col("tracking_number").alias("_trk"),
                      "status", "delivered_datetime")
    j = marks.join(s, marks.delivery_id == s._sid, "left")
    code = (F.when(_falsy("delivery_id"), F.lit(400))
            .when(F.col("_sid").isNull(), F.lit(404)).otherwise(F.lit(200)))
    ok = code == 200
    body = (F.when(code == 400, F.to_json(F.struct(F.lit(ERROR_MISSING_DELIVERY_ID).alias("error"))))
            .when(code == 404, F.to_json(F.struct(F.lit(ERROR_DELIVERY_NOT_FOUND).alias("error"),
                                                  F.col("delivery_id"))))
            .otherwise(F.to_json(F.struct(
                F.col("delivery_id"), F.col("_trk").alias("tracking_number"),
                (F.col("status") == "delivered").alias("is_completed"), F.col("status"),
                F.coalesce(F.col("delivered_datetime").cast("string"), F.lit("")).alias("delivered_datetime")))))
    return j.select(
        "event_id", "ts", "delivery_id", code.alias("status_code"),
        F.when(ok, F.col("_trk")).alias("tracking_number"),
        F.when(ok, F.col("status") == "delivered").alias("is_completed"),
        F.when(ok, F.col("status")).alias("status"),
        F.when(ok, F.col("delivered_datetime")).alias("delivered_datetime"),
        body.alias("body"))


# I2 ---------------------------------------------------------------------
def vehicle_eta(pings: DataFrame) -> DataFrame:
    """Remaining planar distance to the destination and arrival estimate.

    A missing speed counts as 60 km/h; a speed <= 0 gives no ETA.
    """
    speed = F.coalesce(F.col("current_speed_kmh"), F.lit(C.DEFAULT_SPEED_KMH))
    km = C.planar_km("destination.lat", "destination.lon",
                     "current_location.lat", "current_location.lon")
    bad = _falsy("vehicle_id") | F.col("current_location").isNull() | F.col("destination").isNull()
    hours = F.when(speed > 0, km / speed)
    eta = F.timestamp_add("MICROSECOND", F.rint(hours * F.lit(3.6e9)).cast("bigint"), F.col("ts"))
    return pings.select(
        "event_id", "vehicle_id", "ts",
        F.when(bad, 400).otherwise(200).alias("status_code"),
        F.when(~bad, pd_round(km)).alias("distance_remaining_km"),
        F.when(~bad, eta).alias("eta"),
        F.when(~bad, F.rint(hours * 60).cast("bigint")).alias("estimated_minutes"),
        F.when(~bad, speed).alias("current_speed_kmh"),
        "current_location", "destination")


# I3 ---------------------------------------------------------------------
def route_deviation(pings: DataFrame, waypoints: DataFrame) -> DataFrame:
    """Minimum planar distance to the route's waypoints; deviated beyond
    5 km (an empty list is infinitely far, so it always alerts).

    ``waypoints`` holds a list for each route (``waypoints``) or, for long lists, the
    table of :func:`convoy.operators.nearest.cell_index` (``cells``).
    """
    indexed = "cells" in waypoints.columns
    w = waypoints.select(F.col("route_id").alias("_rid"), "cells" if indexed else "waypoints")
    j = pings.join(w, pings.route_id == w._rid, "left")
    bad = _falsy("vehicle_id") | F.col("current_location").isNull() | _falsy("route_id")
    code = F.when(bad, 400).when(F.col("_rid").isNull(), 404).otherwise(200)
    here = F.col("current_location.lat"), F.col("current_location.lon")
    dist = nearest_in_cells_km(F.col("cells"), *here) if indexed else C.nearest_waypoint_km("waypoints", *here)
    ok = code == 200
    return j.select(
        "event_id", "vehicle_id", "driver_id", "route_id", "ts", "current_location",
        code.alias("status_code"),
        F.when(ok, pd_round(dist)).alias("deviation_km"),
        F.when(ok, dist > C.DEVIATION_THRESHOLD_KM).alias("is_deviated"))


def eta_body(etas: DataFrame) -> DataFrame:
    """``event_id, body``: the JSON answer to each ETA request."""
    error = F.to_json(F.struct(F.lit(ERROR_MISSING_FIELDS).alias("error")))
    ok = F.to_json(F.struct(
        "vehicle_id", "distance_remaining_km", F.coalesce(C.iso_text("eta"), F.lit(NO_ETA)).alias("eta"),
        "estimated_minutes"), {"ignoreNullFields": "false"})
    return etas.select("event_id", F.when(F.col("status_code") == 200, ok).otherwise(error).alias("body"))


def deviation_body(checked: DataFrame) -> DataFrame:
    """``event_id, body``: the JSON answer to each deviation check."""
    error = lambda text: F.to_json(F.struct(F.lit(text).alias("error")))
    ok = F.to_json(F.struct(
        "vehicle_id", "is_deviated", "deviation_km", F.col("is_deviated").alias("alert_sent"),
        F.lit(int(C.DEVIATION_THRESHOLD_KM)).alias("threshold_km")))
    code = F.col("status_code")
    return checked.select("event_id", F.when(code == 400, error(ERROR_MISSING_FIELDS))
                          .when(code == 404, error(ERROR_ROUTE_NOT_FOUND)).otherwise(ok).alias("body"))


def deviation_alerts(checked: DataFrame, *more: str) -> DataFrame:
    """Alert rows (the alert history item / message of the source), with the columns ``more``."""
    return checked.where(F.col("is_deviated")).select(
        *more, "vehicle_id", "driver_id", "route_id", "deviation_km", "current_location",
        F.col("ts").alias("timestamp"), F.lit(ALERT_TYPE).alias("alert_type"))


def alert_messages(alerts: DataFrame) -> DataFrame:
    """JSON message per alert, ready for a message sink, with the alert's event id if it has one."""
    return alerts.select(
        *[c for c in ["event_id"] if c in alerts.columns],
        F.col("vehicle_id").cast("string").alias("key"),
        F.to_json(F.struct("vehicle_id", "driver_id", "route_id", "deviation_km",
                           "current_location", C.iso_text("timestamp").alias("timestamp"),
                           "alert_type")).alias("value"))
