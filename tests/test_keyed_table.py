import datetime as dt
import glob
import os
import random

import pytest

from convoy.streaming import jobs as J
from convoy.streaming.keyed_table import KeyedTable

SCHEMA = "k long, ts long, v string"


def _files(path):
    return len(glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_fifty_micro_batches(spark, tmp_dir):
    rng = random.Random(3)
    path = os.path.join(tmp_dir, "t")
    table, want = KeyedTable(spark, path, ["k"], ["ts", "v"], buckets=3), {}
    assert table.read() is None and table.compact() == 0
    most = 0
    for i in range(50):
        rows = [(rng.randrange(20), rng.randrange(200), f"{i}-{j}") for j in range(8)]
        table.put(spark.createDataFrame(rows, SCHEMA), i)
        if i % 7 == 3:  # a retried micro-batch replaces itself
            table.put(spark.createDataFrame(rows, SCHEMA), i)
        for k, ts, v in rows:
            want[k] = max(want.get(k, (-1, "")), (ts, v))
        if i % 10 == 9:
            table.compact()
            table.retire()
            most = max(most, _files(f"{path}/base") + _files(f"{path}/delta"))
    assert {r.k: (r.ts, r.v) for r in table.read().collect()} == want
    # two versions of three buckets, and the micro-batches of the last two compactions at most
    assert most <= 2 * 3 + 10 * 3


def test_a_reader_sees_one_state(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    table = KeyedTable(spark, path, ["k"], ["batch_id"], buckets=2)
    table.put(spark.createDataFrame([(1, 0, "a"), (2, 0, "a")], SCHEMA), 0)
    before = table.read()
    table.put(spark.createDataFrame([(1, 0, "b"), (3, 0, "b")], SCHEMA), 1)
    table.compact()
    table.retire()
    assert sorted((r.k, r.v) for r in before.collect()) == [(1, "a"), (2, "a")]
    now = lambda: sorted((r.k, r.v) for r in table.read().collect())
    assert now() == [(1, "b"), (2, "a"), (3, "b")]
    # a compaction that broke off before its marker changes nothing
    table.put(spark.createDataFrame([(2, 0, "c")], SCHEMA), 2)
    os.makedirs(f"{path}/base/version=2/_bucket=0")
    os.makedirs(f"{path}/delta/batch_id=3")
    assert now() == [(1, "b"), (2, "c"), (3, "b")]
    table.compact()
    assert now() == [(1, "b"), (2, "c"), (3, "b")]


def test_lookup_opens_only_its_buckets(spark, tmp_dir):
    table = KeyedTable(spark, os.path.join(tmp_dir, "t"), ["k"], ["batch_id"], bucket="k div 100")
    table.put(spark.range(2000).selectExpr("id AS k", "0L AS ts", "'x' AS v"), 0)
    table.compact()
    table.put(spark.createDataFrame([(150, 0, "new"), (900, 0, "new")], SCHEMA), 1)
    asked = spark.createDataFrame([(150,), (199,), (1999,), (None,)], "k long")
    buckets = table.buckets_of(asked)
    assert buckets == [1, 19]
    held = table.read(buckets)
    assert {r.v for r in held.where("k = 150").collect()} == {"new"} and held.count() == 200
    assert len(held.inputFiles()) == 3  # two base buckets of twenty, one of two delta buckets


def test_late_pings_never_set_a_vehicle_back(spark, tmp_dir):
    from convoy.sources import events as EV
    from conftest import SF_SMALL
    pings = EV.gps_pings(spark, SF_SMALL)
    EV.write_event_files(pings.orderBy(pings.ts.desc()), os.path.join(tmp_dir, "p"), files=5)
    table = KeyedTable(spark, os.path.join(tmp_dir, "t"), ["vehicle_id"], ["ts", "event_id"], buckets=2)

    def run():
        J.newest_positions(EV.read_event_stream(spark, os.path.join(tmp_dir, "p"), "gps", 1), table, os.path.join(tmp_dir, "c"),
                           trigger="availableNow", compact_every=2).awaitTermination()
        return {r.vehicle_id: (r.ts, r.event_id) for r in table.read().collect()}

    want = {}
    for r in pings.collect():
        want[r.vehicle_id] = max(want.get(r.vehicle_id, (dt.datetime.min, 0)), (r.ts, r.event_id))
    assert run() == want
    assert run() == want  # a restart adds nothing
    EV.write_event_files(pings.orderBy("ts").limit(20), os.path.join(tmp_dir, "p"), files=1)
    assert run() == want


def test_a_changed_status_shows_in_the_next_micro_batch(spark, tmp_dir):
    from convoy.sources import events as EV
    from convoy.sources.schemas import DELIVERY_MARK, STATUS
    at = lambda n: os.path.join(tmp_dir, n)
    status = KeyedTable(spark, at("s"), ["delivery_id"], ["batch_id"], bucket="delivery_id div 10")
    mark = lambda i, d: spark.createDataFrame([(i, dt.datetime(2001, 7, 1), d, "x")], DELIVERY_MARK)

    def run(i, d):
        EV.write_event_files(mark(i, d), at("m"), files=1)
        J.keyed_verification(EV.read_event_stream(spark, at("m"), "marks"), status, at("o"), at("c"), trigger="availableNow").awaitTermination()
        (r,) = spark.read.parquet(at("o")).where(f"event_id = {i}").collect()
        return r.status_code, r.status

    assert run(1, 5) == (404, None) and run(2, None) == (400, None)
    status.put(spark.createDataFrame([(5, "x", "pending", None)], STATUS), 0)
    assert run(3, 5) == (200, "pending")
    status.put(spark.createDataFrame([(5, "x", "delivered", dt.datetime(2001, 7, 2))], STATUS), 1)
    status.compact()
    assert run(4, 5) == (200, "delivered")


def test_messages_are_published_once(spark, tmp_dir):
    out, pub = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "pub")
    for i in range(3):
        spark.createDataFrame([(i * 10 + j, "7", "{}") for j in range(4)], "event_id long, key string, value string").write.parquet(f"{out}/batch_id={i}")

    def crash(rows, i):  # messages are out, the mark is not
        J._write_batch(rows, f"{pub}/messages", i)
        if i == 1:
            raise RuntimeError

    with pytest.raises(RuntimeError):
        J.publish_messages(spark, out, pub, send=crash)
    assert J.publish_messages(spark, out, pub) == 8  # the second and third micro-batch
    assert J.publish_messages(spark, out, pub) == 0
    ids = [r.message_id for r in spark.read.parquet(f"{pub}/messages").collect()]
    assert len(ids) == 12 == len(set(ids))


def test_buckets_follow_the_rows_not_the_span_of_the_ids(spark, monkeypatch):
    from convoy.streaming import queries as Q

    monkeypatch.setattr(Q, "STATUS_ROWS", 50)
    thin = spark.range(1000).selectExpr("id * 100000 delivery_id")
    width = Q.bucket_width(thin, "delivery_id")
    assert thin.selectExpr(f"delivery_id div {width} b").distinct().count() in (20, 21)
    assert Q.bucket_width(thin.limit(0), "delivery_id") == 50
    assert Q.bucket_width(spark.createDataFrame([(None,), (7,)], "delivery_id long"), "delivery_id") == 50
