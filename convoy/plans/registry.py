"""Named queries: ``name -> callable(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from convoy.plans import quality as Q
from convoy.session import configure
from convoy.plans import reports as R
from convoy.plans import schedules as S
from convoy.plans import warehouse_queries as WQ
from convoy.sources.fleet import Fleet, cached_fleet
from convoy.sources import queries as SRC
from convoy.streaming import queries as SQ

QueryFn = Callable[[SparkSession, str], DataFrame]


def _on_fleet(fn, **kw) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(cached_fleet(spark, sf_dir), **kw)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _with_spark(fn, **kw) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, cached_fleet(spark, sf_dir), **kw)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _registry() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {
        "q1_vehicles_by_type": _on_fleet(R.vehicles_by_type),
        "q2_expiring_licenses": _on_fleet(R.expiring_licenses),
        "q3_trips_by_city_status": _on_fleet(R.trips_by_city_status),
        "q4_deliveries_by_city": _on_fleet(R.deliveries_by_city),
        "q5_driver_workload": _on_fleet(R.driver_workload),
        "q6_driver_productivity": _on_fleet(R.driver_productivity),
        "q6_fixed": _on_fleet(R.driver_productivity_fixed),
        "q7_top_fuel_routes": _on_fleet(R.top_fuel_routes),
        "q8_delays_by_weekday": _on_fleet(R.delays_by_weekday),
        "q9_maintenance_cost_ratio": _on_fleet(R.maintenance_cost_ratio),
        "q9_fixed": _on_fleet(R.maintenance_cost_ratio_fixed),
        "q10_driver_efficiency_ranking": _on_fleet(R.driver_efficiency_ranking),
        "q10_fixed": _on_fleet(R.driver_efficiency_ranking_fixed),
        "q11_monthly_trend": _on_fleet(R.monthly_trend),
        # data quality
        "dq_checks": _on_fleet(Q.validation_checks),
        "dq_constraints": _on_fleet(Q.constraint_audit),
        "summary_counts": _on_fleet(Q.table_counts),
        "trip_delivery_stats": _on_fleet(Q.trip_delivery_stats),
        "summary_json": _on_fleet(Q.summary_json, generated_at="2001-08-01 00:00:00"),
        # star-schema batch
        "daily_extract": _on_fleet(WQ.daily_extract),
        "fact_measures": _on_fleet(WQ.fact_measures),
        "fact_rejects": _on_fleet(WQ.fact_rejects),
        "daily_totals": _on_fleet(WQ.daily_totals),
        "dim_customer": _on_fleet(WQ.dim_customer),
        "dim_vehicle": _on_fleet(WQ.dim_vehicle),
        "dim_driver": _on_fleet(WQ.dim_driver),
        "dim_route": _on_fleet(WQ.dim_route),
        "dim_date": _on_fleet(WQ.dim_date),
        "scd2_drivers": _on_fleet(WQ.scd2_drivers),
        "v_sales": _with_spark(WQ.v_sales),
        "v_operations": _with_spark(WQ.v_operations),
        "daily_run": _with_spark(WQ.daily_run),
        "day_totals": _on_fleet(WQ.day_totals),
        "two_day_run": _with_spark(WQ.two_day_run),
        "two_day_customers": _with_spark(WQ.two_day_customers),
        "two_day_drivers": _with_spark(WQ.two_day_drivers),
        "fact_driver_versions": _with_spark(WQ.fact_driver_versions),
        "stored_sales": _with_spark(WQ.stored_sales),
        "stored_operations": _with_spark(WQ.stored_operations),
        "batch_metrics": _with_spark(WQ.batch_metrics),
        "corrected_facts": _with_spark(WQ.corrected_facts),
        "corrected_totals": _with_spark(WQ.corrected_totals),
        "reordered_facts": _with_spark(WQ.reordered_facts),
        "reordered_customers": _with_spark(WQ.reordered_customers),
        "reordered_drivers": _with_spark(WQ.reordered_drivers),
        "reordered_dates": _with_spark(WQ.reordered_dates),
        "reordered_totals": _with_spark(WQ.reordered_totals),
        # re-aimed generator work
        "vehicle_span_as_written": _on_fleet(S.vehicle_span_as_written),
        "vehicle_span": _on_fleet(S.vehicle_span),
        "maintenance_schedule": _with_spark(S.maintenance_schedule),
        "stop_schedule": _on_fleet(S.stop_schedule),
        "weight_allocation": _on_fleet(S.weight_allocation),
        "route_table": _on_fleet(S.route_table),
        # event handlers (batch twins of the streaming jobs) and a streaming run
        "verify_delivery": SQ.verify_delivery,
        "vehicle_eta": SQ.vehicle_eta,
        "route_deviation": SQ.route_deviation,
        "deviation_alerts": SQ.deviation_alerts,
        "stream_deviation_alerts": SQ.stream_deviation_alerts,
        "stream_delivery_verification": SQ.stream_delivery_verification,
        "stream_vehicle_tracking": SQ.stream_vehicle_tracking,
        "latest_ping_per_vehicle": SQ.latest_ping_per_vehicle,
        "verify_bodies": SQ.verify_bodies,
        "eta_bodies": SQ.eta_bodies,
        "deviation_bodies": SQ.deviation_bodies,
        "stream_newest_positions": SQ.stream_newest_positions,
        "stream_tracking_table": SQ.stream_tracking_table,
        "stream_keyed_verification": SQ.stream_keyed_verification,
        "stream_alert_messages": SQ.stream_alert_messages,
        "stop_deviation": SQ.stop_deviation,
        "stream_stop_alerts": SQ.stream_stop_alerts,
        # sources and sinks
        "staging_variant": SRC.staging_variant,
        "snapshot_reconcile": SRC.snapshot_reconcile,
        "snapshot_differences": SRC.snapshot_differences,
    }
    return q


def _configured(fn: QueryFn) -> QueryFn:
    """Apply the runtime SQL settings the plans are written against (UTC
    session zone, ANSI, AQE) to whatever session the caller passes."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, QueryFn] = {k: _configured(v) for k, v in _registry().items()}


def fleet(spark: SparkSession, sf_dir: str) -> Fleet:
    return cached_fleet(spark, sf_dir)
