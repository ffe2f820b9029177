"""Explicit schemas of the fleet model, its events and its warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _s(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


D2 = T.DecimalType(10, 2)
D52 = T.DecimalType(5, 2)
NTZ = T.TimestampNTZType()
L = T.LongType()
S = T.StringType()

FLEET_SCHEMAS = {
    "vehicles": _s(("vehicle_id", L), ("license_plate", S), ("vehicle_type", S),
                   ("capacity_kg", D2), ("fuel_type", S), ("acquisition_date", T.DateType()),
                   ("status", S)),
    "drivers": _s(("driver_id", L), ("employee_code", S), ("first_name", S), ("last_name", S),
                  ("license_number", S), ("license_expiry", T.DateType()), ("phone", S),
                  ("hire_date", T.DateType()), ("status", S)),
    "routes": _s(("route_id", L), ("route_code", S), ("origin_city", S), ("destination_city", S),
                 ("distance_km", D2), ("estimated_duration_hours", D52), ("toll_cost", D2)),
    "trips": _s(("trip_id", L), ("vehicle_id", L), ("driver_id", L), ("route_id", L),
                ("departure_datetime", NTZ), ("arrival_datetime", NTZ),
                ("fuel_consumed_liters", D2), ("total_weight_kg", D2), ("status", S)),
    "deliveries": _s(("delivery_id", L), ("trip_id", L), ("tracking_number", S),
                     ("customer_name", S), ("delivery_address", S), ("package_weight_kg", D2),
                     ("scheduled_datetime", NTZ), ("delivered_datetime", NTZ),
                     ("delivery_status", S), ("recipient_signature", T.BooleanType())),
    "maintenance": _s(("maintenance_id", L), ("vehicle_id", L), ("maintenance_date", T.DateType()),
                      ("maintenance_type", S), ("description", S), ("cost", D2),
                      ("next_maintenance_date", T.DateType()), ("performed_by", S)),
}

POINT = _s(("lat", T.DoubleType()), ("lon", T.DoubleType()))

GPS_PING = _s(("event_id", L), ("vehicle_id", L), ("driver_id", L), ("route_id", L), ("ts", NTZ),
              ("current_location", POINT), ("destination", POINT),
              ("current_speed_kmh", T.DoubleType()))

DELIVERY_MARK = _s(("event_id", L), ("ts", NTZ), ("delivery_id", L), ("tracking_number", S))

WAYPOINTS = _s(("route_id", L), ("waypoints", T.ArrayType(POINT)))

STATUS = _s(("delivery_id", L), ("tracking_number", S), ("status", S), ("delivered_datetime", NTZ))
