import random

from convoy.functions import columns as C
from convoy.operators.nearest import cell_index, nearest_in_cells_km
from convoy.sources.schemas import WAYPOINTS
from convoy.streaming import handlers as H
from pyspark.sql import functions as F

INF, NAN = float("inf"), float("nan")


def _lists():
    r = random.Random(3)
    line = [(4.0 + i / 700, -74.0 + (i % 13) / 9000) for i in range(10_000)]
    field = [(4.0 + r.random(), -74.0 - r.random()) for _ in range(3_000)]
    same = [(4.5, -74.5)] * 40
    flat = [(4.25, -74.0 - i / 10) for i in range(30)]
    odd = [(4.1, -74.1), (None, -74.0), (4.2, None), None, (NAN, -74.0), (4.4, INF), (4.9, -73.0)]
    return [(1, line), (2, field), (3, same), (4, flat), (5, odd), (6, []), (7, None), (8, [(4.0, -74.0)])]


def test_cells_equal_the_scan_to_the_last_bit(spark):
    r = random.Random(4)
    waypoints = spark.createDataFrame(_lists(), WAYPOINTS)
    spots = [(k, 4.0 + r.uniform(-1, 16), -74.0 + r.uniform(-2, 2)) for k in range(1, 9) for _ in range(40)]
    spots += [(k, 4.5, -74.5) for k in range(1, 9)] + [(k, 4.0, -74.0) for k in range(1, 9)] + [(2, None, -74.0)]
    pings = spark.createDataFrame(spots, "route_id long, lat double, lon double")
    index = cell_index(waypoints)
    clean = waypoints.withColumn("waypoints", F.filter("waypoints", lambda p: ~F.isnan(p["lat"])))
    got = (pings.join(index, "route_id").join(clean, "route_id")
           .select("route_id", nearest_in_cells_km(F.col("cells"), F.col("lat"), F.col("lon")).alias("a"),
                   C.nearest_waypoint_km("waypoints", "lat", "lon").alias("b")).collect())
    assert len(got) == len(spots)
    assert [x for x in got if x.a != x.b] == []
    assert {x.a for x in got if x.route_id in (6, 7)} == {INF}


def test_cells_and_boxes_stay_few(spark):
    sizes = {x.route_id: (len(x.cells), max(len(c.points) for c in x.cells), sum(len(c.points) for c in x.cells))
             for x in cell_index(spark.createDataFrame(_lists(), WAYPOINTS)).collect() if x.cells}
    assert sizes[1][2] == 10_000 and sizes[1][0] <= 50 and sizes[1][1] <= 700
    assert sizes[2][2] == 3_000 and sizes[2][0] <= 15 * 15 and sizes[2][1] <= 40
    assert sizes[3] == (1, 40, 40) and sizes[5][2] == 2


def test_handler_takes_lists_or_cells(spark):
    from convoy.sources.schemas import GPS_PING
    import datetime as dt

    r = random.Random(5)
    rows = [(i, i % 3, 7, i % 10, dt.datetime(2001, 7, 1, 8), (4.0 + r.random(), -74.0 - r.random()), (4.0, -74.0), 9.0) for i in range(200)]
    pings, waypoints = spark.createDataFrame(rows, GPS_PING), spark.createDataFrame(_lists(), WAYPOINTS).where("route_id <> 5")
    a = H.route_deviation(pings, waypoints).orderBy("event_id").collect()
    assert a == H.route_deviation(pings, cell_index(waypoints)).orderBy("event_id").collect()
    assert {x.status_code for x in a} == {200, 400, 404}
