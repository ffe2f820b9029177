import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from convoy.sources import events as EV
from convoy.sources.schemas import GPS_PING, WAYPOINTS
from convoy.streaming import handlers as H
from convoy.streaming import jobs as J

T = dt.datetime


def _ping(i, vehicle, route, speed, lat=4.0, lon=-74.0, ts=T(2001, 7, 1, 8)):
    return (i, vehicle, 7, route, ts, (lat, lon), (lat + 0.1, lon), speed)


def test_handlers_edge_cases(spark):
    pings = spark.createDataFrame([
        _ping(1, 5, 1, None), _ping(2, 5, 1, 0.0), _ping(3, 0, 1, 50.0), _ping(4, 5, 2, 30.0),
        _ping(5, 5, 3, 30.0), _ping(6, 5, 0, 30.0)], GPS_PING)
    eta = {r.event_id: r for r in H.vehicle_eta(pings).collect()}
    assert eta[1].current_speed_kmh == 60.0 and eta[1].estimated_minutes == 11   # 11.1 km at 60
    assert eta[2].eta is None and eta[2].estimated_minutes is None               # speed 0
    assert eta[3].status_code == 400                                             # vehicle 0 is falsy
    wp = spark.createDataFrame([(1, [(4.0, -74.0)]), (2, [])], WAYPOINTS)
    dev = {r.event_id: r for r in H.route_deviation(pings, wp).collect()}
    assert dev[1].deviation_km == 0.0 and not dev[1].is_deviated
    assert dev[4].deviation_km == float("inf") and dev[4].is_deviated           # empty list
    assert dev[5].status_code == 404 and dev[6].status_code == 400


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_dir):
    pings = EV.gps_pings(spark, SF_SMALL)
    wp = EV.route_waypoints(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "pings")
    EV.write_event_files(pings, src)
    alerts, msgs, ck = (os.path.join(tmp_dir, p) for p in ("alerts", "msgs", "ck"))

    def run():
        q = J.route_deviation_alerts(EV.read_event_stream(spark, src, "gps", 1), wp,
                                     alerts, msgs, ck, trigger="availableNow")
        q.awaitTermination()

    run()
    streamed = spark.read.parquet(alerts).drop("batch_id", "event_id")
    batch = H.deviation_alerts(H.route_deviation(pings, wp))
    assert sorted(streamed.collect()) == sorted(batch.collect())
    n = streamed.count()
    assert spark.read.parquet(msgs).count() == n
    run()                                   # restart on the same checkpoint: nothing new
    assert spark.read.parquet(alerts).count() == n
    # a retried ping file adds raw rows, but the keyed read collapses them
    EV.write_event_files(spark.read.parquet(src).limit(50), src, files=1)
    run()
    keyed = J.read_keyed(spark, alerts, ["vehicle_id", "timestamp"])
    assert keyed.count() == streamed.select("vehicle_id", "timestamp").distinct().count()


def test_watermark_dedupe_is_opt_in(spark, tmp_dir):
    pings = EV.gps_pings(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "pings")
    EV.write_event_files(pings.unionByName(pings.limit(30)), src, files=1)
    out = os.path.join(tmp_dir, "tracking")
    J.vehicle_tracking(EV.read_event_stream(spark, src, "gps"), out, os.path.join(tmp_dir, "ck"),
                       trigger="availableNow", dedupe_delay="100000 days",
                       latest_only=False).awaitTermination()
    got = spark.read.parquet(out)
    valid = H.vehicle_eta(pings).where("status_code = 200")     # only valid events are stored
    assert got.count() == valid.dropDuplicates(["vehicle_id", "ts"]).count()


def test_delivery_verification_stream(spark, tmp_dir):
    from convoy.sources.fleet import cached_fleet
    marks = EV.delivery_marks(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "marks")
    EV.write_event_files(marks, src)
    status = EV.delivery_status(cached_fleet(spark, SF_SMALL))
    out = os.path.join(tmp_dir, "responses")
    J.delivery_verification(EV.read_event_stream(spark, src, "marks"), status, out,
                            os.path.join(tmp_dir, "ck"), trigger="availableNow").awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == marks.count()
    codes = {r.status_code for r in got.select("status_code").distinct().collect()}
    assert codes == {200, 400, 404}
    assert got.where("status_code = 200 and body not like '%is_completed%'").count() == 0


def test_eta_tracking_keyed_table(spark, tmp_dir):
    pings = EV.gps_pings(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "pings")
    EV.write_event_files(pings, src)
    out = os.path.join(tmp_dir, "tracking")
    J.vehicle_tracking(EV.read_event_stream(spark, src, "gps", 2), out,
                       os.path.join(tmp_dir, "ck"), trigger="availableNow",
                       latest_only=False).awaitTermination()
    table = J.read_keyed(spark, out, ["vehicle_id", "ts"])
    valid = H.vehicle_eta(pings).where("status_code = 200")
    assert table.count() == valid.select("vehicle_id", "ts").distinct().count()


def test_eta_latest_position_per_vehicle(spark, tmp_dir):
    pings = EV.gps_pings(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "pings")
    EV.write_event_files(pings, src)
    out = os.path.join(tmp_dir, "tracking")
    J.vehicle_tracking(EV.read_event_stream(spark, src, "gps"), out, os.path.join(tmp_dir, "ck"),
                       trigger="availableNow").awaitTermination()
    got = {r.vehicle_id: r.ts for r in spark.read.parquet(out).collect()}
    valid = H.vehicle_eta(pings).where("status_code = 200")
    want = {r.vehicle_id: r.ts for r in valid.groupBy("vehicle_id").agg(F.max("ts").alias("ts")).collect()}
    assert got == want


def test_response_bodies(spark):
    import json

    from convoy.streaming import handlers as H
    etas = spark.sql("""select 1L event_id, 7L vehicle_id, 200 status_code, 12.5D distance_remaining_km,
        timestamp_ntz'2001-08-01 10:30:00' eta, 15L estimated_minutes
        union all select 2, 7, 200, 3.0, null, null union all select 3, null, 400, null, null, null""")
    got = {r.event_id: json.loads(r.body) for r in H.eta_body(etas).collect()}
    assert got[1] == {"vehicle_id": 7, "distance_remaining_km": 12.5, "eta": got[1]["eta"], "estimated_minutes": 15}
    assert got[1]["eta"].startswith("2001-08-01T10:30:00")
    assert got[2] == {"vehicle_id": 7, "distance_remaining_km": 3.0, "eta": H.NO_ETA, "estimated_minutes": None}
    assert got[3] == {"error": H.ERROR_MISSING_FIELDS}
    checked = spark.sql("""select 1L event_id, 7L vehicle_id, 200 status_code, 6.25D deviation_km, true is_deviated
        union all select 2, 7, 404, null, null union all select 3, null, 400, null, null""")
    got = {r.event_id: json.loads(r.body) for r in H.deviation_body(checked).collect()}
    assert got[1] == {"vehicle_id": 7, "is_deviated": True, "deviation_km": 6.25, "alert_sent": True, "threshold_km": 5}
    assert got[2] == {"error": H.ERROR_ROUTE_NOT_FOUND} and got[3] == {"error": H.ERROR_MISSING_FIELDS}


def test_pings_of_one_file_are_searched_by_many_tasks(spark, tmp_path):
    import os
    from convoy.sources import events as EV
    from convoy.streaming import jobs as J

    EV.write_event_files(EV.gps_pings(spark, SF_SMALL), str(tmp_path / "pings"), files=1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        J.route_deviation_alerts(EV.read_event_stream(spark, str(tmp_path / "pings"), "gps"), EV.route_waypoints(spark, SF_SMALL),
                                 str(tmp_path / "alerts"), str(tmp_path / "messages"), str(tmp_path / "ck"), trigger="availableNow").awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for _, _, fs in os.walk(tmp_path / "alerts") for f in fs if f.endswith(".parquet")]
    assert len(files) > 1
