import datetime as dt
from decimal import Decimal as D

from conftest import make_fleet
from convoy.plans import schedules as S

T = dt.datetime


def _trip(i, vehicle, dep, arr):
    return (i, vehicle, 1, 1, dep, arr, D("1"), D("1"), "completed")


def test_maintenance_schedule_spacing_and_cap(spark):
    veh = (1, "V1", "Van", D("1"), "diesel", None, "active")
    trips = [_trip(i, 1, T(2000, 1, 1, 8) + dt.timedelta(days=i), T(2000, 1, 1, 9) + dt.timedelta(days=i))
             for i in range(45)]                                   # 45 trips -> 2 services
    f = make_fleet(spark, vehicles=[veh], trips=trips)
    got = S.maintenance_schedule(spark, f).orderBy("service_number").collect()
    assert [r.service_number for r in got] == [0, 1]
    # 44 days 1 h of operation -> 44 whole days; offsets floor(44*1/3)=14, floor(44*2/3)=29
    assert [r.maintenance_date for r in got] == [dt.date(2000, 1, 15), dt.date(2000, 1, 30)]
    assert got[0].maintenance_type == S.MAINTENANCE_TYPES[1][0]   # (vehicle 1 + 0) mod 6
    assert got[0].next_maintenance_date == dt.date(2000, 1, 15) + dt.timedelta(days=60)
    assert got[0].description == f"{S.MAINTENANCE_TYPES[1][0]} programado para 2000-01-15"
    assert S.maintenance_schedule(spark, f, max_records=1).count() == 1


def test_stop_schedule_slots(spark):
    trips = [_trip(1, 1, T(2000, 1, 1, 8), T(2000, 1, 1, 12)), _trip(2, 1, T(2000, 1, 1, 8), None)]
    dels = [(i, t, f"FL{i}", "c", "a", D("1"), None, None, "pending", False)
            for i, t in [(1, 1), (2, 1), (3, 2)]]
    f = make_fleet(spark, trips=trips, deliveries=dels)
    got = {(r.trip_id, r.stop_index): r.planned_datetime for r in S.stop_schedule(f).collect()}
    assert got == {(1, 0): T(2000, 1, 1, 9), (1, 1): T(2000, 1, 1, 11),
                   (2, 0): T(2000, 1, 1, 8, 15)}


def test_route_table_pairs_and_codes(spark):
    routes = [(1, "R1", "A", "B", D("120.00"), D("2"), D("0")),
              (2, "R2", "B", "A", D("900.00"), D("2"), D("0")),
              (3, "R3", "B", "C", D("250.00"), D("2"), D("0"))]
    f = make_fleet(spark, routes=routes)
    got = S.route_table(f).orderBy("route_code").collect()
    # hub = A: pairs with A get 3 variants (4 pairs), B-C/C-B get 2 -> 16 routes
    assert len(got) == 16 and got[0].route_code == "R001" and got[-1].route_code == "R016"
    by_pair = {(r.origin_city, r.destination_city): r for r in got}
    assert by_pair[("A", "B")].distance_km == D("120.00")        # unordered lookup, min of A-B
    assert by_pair[("C", "A")].distance_km == D("500.00")        # missing pair -> default
    assert by_pair[("C", "B")].toll_cost == D("30000.00")        # floor(250/100) * 15000
    assert S.route_table(f, count=5).count() == 5


def test_route_table_reverse_only_and_numeric_cap(spark):
    f = make_fleet(spark, routes=[(1, "R1", "Z", "A", D("250.00"), D("2"), D("0"))])
    assert {r.distance_km for r in S.route_table(f).collect()} == {D("250.00")}
    many = make_fleet(spark, routes=[(i, f"R{i}", "A", f"C{i:02d}", D("100.00"), D("1"), D("0")) for i in range(24)])
    got = sorted(int(r.route_code[1:]) for r in S.route_table(many, count=200).collect())
    assert got == list(range(1, 201))
