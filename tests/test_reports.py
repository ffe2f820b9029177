"""Report semantics on hand-made rows."""
import datetime as dt
from decimal import Decimal as D

from conftest import make_fleet
from convoy.plans import reports as R

T = dt.datetime


def _driver(i, first, last, status="active", expiry=dt.date(2001, 8, 10)):
    return (i, f"EMP{i}", first, last, f"LIC{i}", expiry, "300", dt.date(1995, 1, 1), status)


def _trip(i, driver, route=1, vehicle=1, dep=T(2001, 7, 1, 8), arr=T(2001, 7, 1, 12),
          fuel=D("10.00"), weight=D("100.00"), status="completed"):
    return (i, vehicle, driver, route, dep, arr, fuel, weight, status)


def _delivery(i, trip, sched, delivered, status="delivered", addr="Calle 1, LIMA", kg=D("2.00")):
    return (i, trip, f"FL{i}", "Customer 1", addr, kg, sched, delivered, status, True)


ROUTE = (1, "R1", "A", "B", D("100.00"), D("2.00"), D("15000.00"))


def test_namesakes_merge_and_null_name(spark):
    f = make_fleet(spark, drivers=[_driver(1, "Ana", "Diaz"), _driver(2, "Ana", "Diaz"),
                                   _driver(3, None, "Solo"), _driver(4, "Inactivo", "X", "inactive")],
                   trips=[_trip(10, 1), _trip(11, 2), _trip(12, 3), _trip(13, 4)])
    got = {r.nombre: r.viajes for r in R.driver_workload(f).collect()}
    assert got == {"Ana Diaz": 2, " Solo": 1}


def test_expiring_licenses_window(spark):
    as_of = "2001-08-01 00:00:00"
    f = make_fleet(spark, drivers=[
        _driver(1, "a", "b", expiry=dt.date(2001, 8, 1)),    # today at midnight: included
        _driver(2, "a", "b", expiry=dt.date(2001, 8, 31)),   # now + 30 days: included
        _driver(3, "a", "b", expiry=dt.date(2001, 9, 1)),    # beyond
        _driver(4, "a", "b", expiry=dt.date(2001, 7, 31)),   # past
        _driver(5, "a", "b", status="inactive")])
    assert [r.driver_id for r in R.expiring_licenses(f, as_of).collect()] == [1, 2]
    later = "2001-08-01 09:00:00"                            # after midnight today drops out
    assert [r.driver_id for r in R.expiring_licenses(f, later).collect()] == [2]


def test_city_from_address_tail(spark):
    f = make_fleet(spark, deliveries=[
        _delivery(1, 1, T(2001, 7, 30), T(2001, 7, 30), addr="Calle 5, Lima  "),
        _delivery(2, 1, T(2001, 7, 30), T(2001, 7, 30), addr="Sin coma"),
        _delivery(3, 1, T(2001, 7, 30), T(2001, 7, 30), addr="x, y, Lima"),
        _delivery(4, 1, T(2001, 1, 1), T(2001, 1, 1), addr="x, Old")])   # older than 60 days
    got = {r.ciudad: r.viajes for r in R.deliveries_by_city(f).collect()}
    assert got == {"Lima": 2, "Sin coma": 1}


def test_late_is_strictly_more_than_two_hours(spark):
    s = T(2001, 7, 2, 8)    # a Monday
    f = make_fleet(spark, deliveries=[
        _delivery(1, 1, s, s + dt.timedelta(hours=2)),
        _delivery(2, 1, s, s + dt.timedelta(hours=2, minutes=1)),
        _delivery(3, 1, s, None, status="pending")])
    (row,) = R.delays_by_weekday(f).collect()
    assert row.dia_semana == "MONDAY   "
    assert (row.total_retraso, row.total_entregado, row.porcentaje_retraso) == (1, 2, 50.0)


def test_monthly_trend_zero_previous(spark):
    rows = []
    for i, (m, late) in enumerate([(5, 0), (6, 1), (7, 1)]):
        s = T(2001, m, 10, 8)
        rows.append(_delivery(i, 1, s, s + dt.timedelta(hours=3 if late else 0)))
    f = make_fleet(spark, deliveries=rows)
    got = R.monthly_trend(f).collect()
    assert [r.mes_name for r in got] == ["2001-05", "2001-06", "2001-07"]
    assert [r.retrasos_mes_anterior for r in got] == [None, 0, 1]
    assert [r.retrasos_mes_siguiente for r in got] == [1, 1, None]
    # previous month 0 -> NULL instead of a division error
    assert [r.variacion_porcentajes_retrasos_vs_mes_anterior for r in got] == [None, None, 0.0]


def test_fuel_ratio_rounds_half_up(spark):
    # 1.005 litres per km * 100 = 100.5 -> exact decimal rounding
    f = make_fleet(spark, routes=[ROUTE], trips=[_trip(1, 1, fuel=D("100.50"))])
    (row,) = R.top_fuel_routes(f).collect()
    assert row.consumo_en_100km == 100.5
    assert (row.total_km, row.consumo) == (100, 101)


def test_maintenance_ratio_pairs_without_fanout(spark):
    veh = (1, "V1", "Van", D("1500"), "diesel", dt.date(1995, 1, 1), "active")
    f = make_fleet(spark, vehicles=[veh], routes=[ROUTE],
                   trips=[_trip(1, 1), _trip(2, 1)],
                   maintenance=[(1, 1, dt.date(2000, 1, 1), "oil", "", D("10.00"), None, ""),
                                (2, 1, dt.date(2000, 2, 1), "oil", "", D("30.00"), None, ""),
                                (3, 1, dt.date(2000, 3, 1), "tyre", "", D("5.00"), None, "")])
    got = {r.tipo_mantenimiento: r.costo_por_km for r in R.maintenance_cost_ratio(f).collect()}
    # oil: pairs = 2 trips x 2 services; cost sum = 2*(10+30) = 80, km = 2*2*100 = 400
    assert got == {"oil": 20.0, "tyre": 5.0}
