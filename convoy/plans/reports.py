"""The eleven fleet reports, as DataFrame plans.

Each function takes a :class:`convoy.sources.fleet.Fleet` and returns a lazy
DataFrame. Output column names are the lower-case names of the source report.
``as_of`` replaces the wall clock so results are repeatable.

Scale notes (what each plan shuffles):

* aggregations run partial (map-side) first, so a hot key collapses before
  the shuffle;
* every join is left to AQE, which broadcasts a side whose measured size
  allows it and shuffles otherwise;
* where a report joins a per-row fact to a dimension only to group by a
  dimension attribute, the fact is first reduced by the join key (Q5, Q6,
  Q9, Q10), so the join sees one row per key instead of one per fact row;
* the only global windows (Q11) run over one row per calendar month; the
  driver ranking (Q10) uses :func:`convoy.operators.ranking.with_ranks`
  (quantile buckets, partitioned windows) instead of a single-partition
  window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convoy.functions import columns as C
from convoy.operators.lineage import materialize
from convoy.operators.ranking import with_ranks
from convoy.sources.fleet import Fleet

DEFAULT_AS_OF = "2001-08-01 00:00:00"


def _ts(as_of) -> F.Column:
    return F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of


def _named_drivers(fleet: Fleet) -> DataFrame:
    return fleet.drivers.select("driver_id", "status", C.full_name().alias("nombre"))


# Q1 ---------------------------------------------------------------------
def vehicles_by_type(fleet: Fleet) -> DataFrame:
    return (fleet.vehicles.groupBy(F.col("vehicle_type").alias("tipo_vehiculo"))
            .agg(F.count("vehicle_id").alias("cantidad_vehiculos")))


# Q2 ---------------------------------------------------------------------
def expiring_licenses(fleet: Fleet, as_of=DEFAULT_AS_OF, days: int = 30) -> DataFrame:
    now = _ts(as_of)
    horizon = now + F.make_dt_interval(days=F.lit(days))
    expiry = F.col("license_expiry").cast("timestamp_ntz")
    return (fleet.drivers
            .where(expiry.between(now, horizon) & (F.col("status") == "active"))
            .select("driver_id", C.full_name().alias("nombre"), "license_expiry", "status")
            .orderBy(F.col("license_expiry").asc_nulls_last(), "driver_id"))


# Q3 ---------------------------------------------------------------------
def trips_by_city_status(fleet: Fleet) -> DataFrame:
    r = fleet.routes.select("route_id", "destination_city")
    return (fleet.trips.join(r, "route_id")
            .groupBy("destination_city", "status")
            .agg(F.count("trip_id").alias("viajes"))
            .select(F.col("destination_city").alias("ciudad_viaje"), "viajes",
                    F.col("status").alias("estado")))


# Q4 ---------------------------------------------------------------------
def deliveries_by_city(fleet: Fleet, as_of=DEFAULT_AS_OF, days: int = 60) -> DataFrame:
    since = _ts(as_of) - F.make_dt_interval(days=F.lit(days))
    return (fleet.deliveries.where(F.col("delivered_datetime") >= since)
            .groupBy(C.address_city().alias("ciudad"))
            .agg(F.count("delivery_id").alias("viajes"),
                 C.dsum("package_weight_kg").alias("total_kg"))
            .select("viajes", "ciudad", "total_kg")
            .orderBy(F.col("viajes").desc_nulls_first(), "ciudad"))


# Q5 ---------------------------------------------------------------------
def driver_workload(fleet: Fleet) -> DataFrame:
    per_driver = fleet.trips.groupBy("driver_id").agg(F.count("route_id").alias("n"))
    active = _named_drivers(fleet).where(F.col("status") == "active")
    return (per_driver.join(active, "driver_id")
            .groupBy("nombre").agg(F.sum("n").alias("viajes"))
            .orderBy(F.col("viajes").desc_nulls_first(), "nombre"))


# Q6 ---------------------------------------------------------------------
def driver_productivity(fleet: Fleet, as_of=DEFAULT_AS_OF, months: int = 6) -> DataFrame:
    """As written: averages the delivery id and sums trip measures once per
    delivery (kept for parity; see :func:`driver_productivity_fixed`).

    Deliveries are reduced per driver id before the names are joined, so the
    drivers join sees one row per driver instead of one per delivery.
    """
    since = _ts(as_of) - F.make_ym_interval(months=F.lit(months))
    d = fleet.deliveries.where(F.col("delivered_datetime") >= since) \
        .select("delivery_id", "trip_id")
    t = fleet.trips.select("trip_id", "driver_id", "total_weight_kg", "fuel_consumed_liters")
    per_driver = (d.join(t, "trip_id").groupBy("driver_id")
                  .agg(F.sum(F.col("delivery_id").cast("decimal(38,0)")).alias("id_sum"), F.count("delivery_id").alias("n"),
                       F.sum(F.col("total_weight_kg").cast("decimal(38,2)")).alias("kg"),
                       F.sum(F.col("fuel_consumed_liters").cast("decimal(38,2)")).alias("fuel")))
    return (per_driver.join(_named_drivers(fleet), "driver_id")
            .groupBy("nombre")
            .agg(C.round2(C.ratio(F.sum("id_sum"), F.sum("n")), 0).alias("promedio_entregas"),
                 F.sum("kg").alias("total_kg"),
                 F.sum("fuel").alias("consumo"))
            .orderBy(F.col("promedio_entregas").desc_nulls_first(), "nombre"))


def driver_productivity_fixed(fleet: Fleet, as_of=DEFAULT_AS_OF, months: int = 6) -> DataFrame:
    """Deliveries per driver name per active month, with trip measures
    counted once per trip (trip-level pre-aggregation before the join)."""
    since = _ts(as_of) - F.make_ym_interval(months=F.lit(months))
    per_trip = (fleet.deliveries.where(F.col("delivered_datetime") >= since)
                .groupBy("trip_id")
                .agg(F.count("delivery_id").alias("n_deliveries"),
                     F.min(C.month_start("delivered_datetime")).alias("first_month")))
    t = fleet.trips.select("trip_id", "driver_id", "total_weight_kg", "fuel_consumed_liters")
    per_driver_month = (per_trip.join(t, "trip_id").join(_named_drivers(fleet), "driver_id")
                        .groupBy("nombre", "first_month")
                        .agg(F.sum("n_deliveries").alias("n"),
                             F.sum("total_weight_kg").alias("kg"),
                             F.sum("fuel_consumed_liters").alias("fuel")))
    return (per_driver_month.groupBy("nombre")
            .agg(C.round2(F.avg("n")).alias("promedio_entregas_mes"),
                 F.sum("n").alias("total_entregas"),
                 F.sum("kg").cast("decimal(38,2)").alias("total_kg"),
                 F.sum("fuel").cast("decimal(38,2)").alias("consumo")))


# Q7 ---------------------------------------------------------------------
def top_fuel_routes(fleet: Fleet, k: int = 10) -> DataFrame:
    r = fleet.routes.select("route_id", "route_code", "origin_city",
                                        "destination_city", "distance_km")
    agg = (fleet.trips.select("route_id", "fuel_consumed_liters").join(r, "route_id")
           .groupBy("route_code", "origin_city", "destination_city")
           .agg(F.sum("distance_km").alias("km"), F.sum("fuel_consumed_liters").alias("fuel")))
    return (agg.select("route_code", "origin_city", "destination_city",
                       F.round("km", 0).cast("bigint").alias("total_km"),
                       F.round("fuel", 0).cast("bigint").alias("consumo"),
                       C.pct("fuel", "km").alias("consumo_en_100km"))
            .orderBy(F.col("consumo_en_100km").desc_nulls_first(), F.col("route_code").asc())
            .limit(k))


# Q8 ---------------------------------------------------------------------
def delays_by_weekday(fleet: Fleet) -> DataFrame:
    d = fleet.deliveries.where(F.col("delivery_status") == "delivered")
    return (d.groupBy(C.weekday_label("scheduled_datetime").alias("dia_semana"))
            .agg(F.sum(C.late_flag()).alias("total_retraso"),
                 F.count("delivery_id").alias("total_entregado"))
            .withColumn("porcentaje_retraso", C.pct("total_retraso", "total_entregado")))


# Q9 ---------------------------------------------------------------------
def maintenance_cost_ratio(fleet: Fleet) -> DataFrame:
    """Per maintenance type: sum(cost) / sum(km) * 100 over the pairs
    (trip, maintenance) of the same vehicle, as written.

    The pairs are never formed: with per-vehicle trip totals (count, km) and
    per-(vehicle, type) maintenance totals (count, cost), the pair sums are
    sum_v km_v * m_vt and sum_v n_v * cost_vt.
    """
    r = fleet.routes.select("route_id", "distance_km")
    per_vehicle = (fleet.trips.select("vehicle_id", "route_id").join(r, "route_id")
                   .groupBy("vehicle_id")
                   .agg(F.count(F.lit(1)).alias("n_trips"), F.sum("distance_km").alias("km")))
    per_type = (fleet.maintenance.groupBy("vehicle_id", "maintenance_type")
                .agg(F.count("maintenance_id").alias("n_maint"), F.sum("cost").alias("cost")))
    pairs = per_type.join(per_vehicle, "vehicle_id")
    return (pairs.groupBy("maintenance_type")
            .agg(F.sum(F.col("km") * F.col("n_maint")).alias("total_viajado"),
                 F.sum(F.col("cost") * F.col("n_trips")).alias("costo_mantenimiento"))
            .select(F.col("maintenance_type").alias("tipo_mantenimiento"),
                    C.pct("costo_mantenimiento", "total_viajado").alias("costo_por_km")))


def maintenance_cost_ratio_fixed(fleet: Fleet) -> DataFrame:
    """Per vehicle type: maintenance cost per km driven (each trip and each
    maintenance counted once)."""
    r = fleet.routes.select("route_id", "distance_km")
    v = fleet.vehicles.select("vehicle_id", "vehicle_type")
    km = (fleet.trips.select("vehicle_id", "route_id").join(r, "route_id")
          .groupBy("vehicle_id").agg(F.sum("distance_km").alias("km")))
    cost = fleet.maintenance.groupBy("vehicle_id").agg(F.sum("cost").alias("cost"))
    per_vehicle = v.join(km, "vehicle_id", "left").join(cost, "vehicle_id", "left")
    return (per_vehicle.groupBy(F.col("vehicle_type").alias("tipo_vehiculo"))
            .agg(F.sum("cost").cast("decimal(38,2)").alias("costo_mantenimiento"),
                 F.sum("km").cast("decimal(38,2)").alias("total_km"))
            .withColumn("costo_por_km", C.round2(C.ratio("costo_mantenimiento", "total_km"))))


# Q10 --------------------------------------------------------------------
def _driver_metrics(fleet: Fleet) -> DataFrame:
    """Per driver name: km per litre, mean deliveries per week, mean lateness
    of late deliveries (seconds). Inner join of the three, as the report."""
    names = _named_drivers(fleet).select("driver_id", "nombre")
    r = fleet.routes.select("route_id", "distance_km")
    t = fleet.trips.select("trip_id", "driver_id", "route_id", "fuel_consumed_liters")

    # Trip measures are reduced per driver id before the names are joined.
    per_driver = (t.join(r, "route_id").groupBy("driver_id")
                  .agg(F.sum("distance_km").alias("km"), F.sum("fuel_consumed_liters").alias("fuel")))
    consumo = (per_driver.join(names, "driver_id")
               .groupBy("nombre")
               .agg(F.sum("km").alias("km"), F.sum("fuel").alias("fuel"))
               .select("nombre", C.round2(C.ratio("km", "fuel")).alias("consumo_km")))

    # One pass over deliveries feeds both delivery metrics: per (driver, week)
    # count the delivered rows and accumulate the late seconds, then merge
    # namesakes per (name, week).
    late = F.col("delivered_datetime").isNotNull() & C.is_late()
    late_s = F.timestamp_diff("SECOND", F.col("scheduled_datetime") + F.expr("INTERVAL 2 HOURS"),
                              F.col("delivered_datetime"))
    delivered = F.col("delivery_status") == "delivered"
    d = (fleet.deliveries.where(delivered | late)
         .select("trip_id", "delivered_datetime",
                 delivered.alias("is_del"), late.alias("is_late"),
                 F.when(late, late_s).alias("late_s")))
    per_driver_week = (d.join(t.select("trip_id", "driver_id"), "trip_id")
                       .groupBy("driver_id", C.week_start("delivered_datetime").alias("semana"))
                       .agg(F.count_if("is_del").alias("n_del"),
                            F.count_if("is_late").alias("n_late"),
                            F.sum("late_s").alias("late_s")))
    weekly = (per_driver_week.join(names, "driver_id")
              .groupBy("nombre", "semana")
              .agg(F.sum("n_del").alias("n_del"), F.sum("n_late").alias("n_late"),
                   F.sum("late_s").alias("late_s")))
    per_name = (weekly.groupBy("nombre")
                .agg(F.avg(F.when(F.col("n_del") > 0, F.col("n_del"))).alias("avg_week"),
                     F.sum("n_late").alias("n_late"), F.sum("late_s").alias("late_s")))
    entregas = per_name.where(F.col("avg_week").isNotNull()) \
        .select("nombre", C.round2("avg_week").alias("promedio_entregas"))
    retraso = per_name.where(F.col("n_late") > 0) \
        .select("nombre", (F.col("late_s") / F.col("n_late")).alias("promedio_retraso_s"))
    return consumo.join(entregas, "nombre").join(retraso, "nombre")


def _ranked(metrics: DataFrame, consumo_ascending: bool, k: int) -> DataFrame:
    # One row per driver name, read by the rank table, the stacked rows and
    # the final join: checkpoint it once instead of recomputing it.
    metrics = materialize(metrics)
    m = with_ranks(metrics, [("consumo_km", "rank_consumo", consumo_ascending),
                             ("promedio_entregas", "rank_entregas", False),
                             ("promedio_retraso_s", "rank_retraso", True)], row_key="nombre")
    total = F.col("rank_consumo") + F.col("rank_entregas") + F.col("rank_retraso")
    return (m.select("nombre", "rank_consumo", "rank_entregas", "rank_retraso",
                     total.alias("ranking_total"))
            .orderBy(F.col("ranking_total").asc(), F.col("nombre").asc())
            .limit(k))


def driver_efficiency_ranking(fleet: Fleet, k: int = 20) -> DataFrame:
    """As written: km per litre ranked ascending (least efficient first)."""
    return _ranked(_driver_metrics(fleet), True, k)


def driver_efficiency_ranking_fixed(fleet: Fleet, k: int = 20) -> DataFrame:
    """Most km per litre ranks first."""
    return _ranked(_driver_metrics(fleet), False, k)


# Q11 --------------------------------------------------------------------
def monthly_trend(fleet: Fleet) -> DataFrame:
    d = fleet.deliveries.where((F.col("delivery_status") == "delivered")
                               & F.col("delivered_datetime").isNotNull())
    months = (d.groupBy(C.month_start("delivered_datetime").alias("mes"))
              .agg(F.count(F.lit(1)).alias("total_entregas"),
                   F.sum(C.late_flag()).alias("total_retrasos")))
    # One row per calendar month: the global window is bounded by the span.
    w = Window.orderBy("mes")
    prev = F.lag("total_retrasos").over(w)
    return (months
            .select("mes", F.date_format("mes", "yyyy-MM").alias("mes_name"),
                    "total_entregas", "total_retrasos",
                    C.pct("total_retrasos", "total_entregas").alias("porcentaje_retrasos"),
                    prev.alias("retrasos_mes_anterior"),
                    F.lead("total_retrasos").over(w).alias("retrasos_mes_siguiente"))
            .withColumn("variacion_porcentajes_retrasos_vs_mes_anterior",
                        C.pct(F.col("total_retrasos") - F.col("retrasos_mes_anterior"),
                              "retrasos_mes_anterior"))
            .orderBy("mes").drop("mes"))
