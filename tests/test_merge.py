import datetime as dt

from convoy.operators.merge import insert_missing, latest_per_key, point_in_time, scd2_apply

SCHEMA = "driver_id bigint, name string, status string"


def test_scd2_two_batches(spark):
    b1 = spark.createDataFrame([(1, "a", "active"), (2, "b", "active"), (3, "c", "active")], SCHEMA)
    b2 = spark.createDataFrame([(1, "a", "active"),        # unchanged
                                (2, "b", "inactive"),      # changed
                                (4, "d", "active")], SCHEMA)  # new; 3 absent
    d1 = scd2_apply(None, b1, "driver_id", ["name", "status"], "2001-07-01", "k")
    d2 = scd2_apply(d1, b2, "driver_id", ["name", "status"], "2001-08-01", "k")
    rows = sorted((r.driver_id, r.status, str(r.valid_from), str(r.valid_to), r.is_current)
                  for r in d2.collect())
    assert rows == [
        (1, "active", "2001-07-01", "2262-04-11", True),
        (2, "active", "2001-07-01", "2001-08-01", False),
        (2, "inactive", "2001-08-01", "2262-04-11", True),
        (3, "active", "2001-07-01", "2262-04-11", True),
        (4, "active", "2001-08-01", "2262-04-11", True),
    ]
    # one current row per key, no overlapping validity, unique surrogate keys
    assert d2.where("is_current").groupBy("driver_id").count().where("count > 1").count() == 0
    assert d2.select("k").distinct().count() == d2.count()
    # applying the same snapshot again changes nothing
    d3 = scd2_apply(d2, b2, "driver_id", ["name", "status"], "2001-08-01", "k")
    assert sorted(d3.collect()) == sorted(d2.collect())


def test_point_in_time_lookup(spark):
    b1 = spark.createDataFrame([(2, "b", "active")], SCHEMA)
    b2 = spark.createDataFrame([(2, "b", "inactive")], SCHEMA)
    d = scd2_apply(scd2_apply(None, b1, "driver_id", ["status"], "2001-07-01", "k"),
                   b2, "driver_id", ["status"], "2001-08-01", "k")
    facts = spark.createDataFrame(
        [(1, 2, dt.datetime(2001, 7, 15)), (2, 2, dt.datetime(2001, 8, 1, 9)),
         (3, 2, dt.datetime(2001, 6, 1)), (4, 9, dt.datetime(2001, 7, 15))],
        "fact int, driver_id bigint, at timestamp_ntz")
    got = point_in_time(facts, d, "driver_id", "at", "k")
    keys = dict(d.select("status", "k").collect())
    res = {r.fact: r.k for r in got.collect()}
    assert res == {1: keys["active"], 2: keys["inactive"], 3: -1, 4: -1}


def test_insert_missing_and_latest(spark):
    t = spark.createDataFrame([("x", 1)], "name string, n int")
    s = spark.createDataFrame([("x", 5), ("y", 2)], "name string, n int")
    assert sorted(insert_missing(t, s, ["name"]).collect()) == [("x", 1), ("y", 2)]
    ev = spark.createDataFrame([(1, 10, "a"), (1, 20, "b"), (2, 5, "c")], "k int, ts int, v string")
    assert sorted(latest_per_key(ev, ["k"], "ts").collect()) == [(1, 20, "b"), (2, 5, "c")]


def test_scd2_type1_columns_overwrite_in_place(spark):
    schema = "driver_id bigint, status string, rating string"
    b1 = spark.createDataFrame([(1, "active", "Alto"), (2, "active", "Bajo")], schema)
    b2 = spark.createDataFrame([(1, "active", "Medio"), (2, "inactive", "Alto")], schema)
    d1 = scd2_apply(None, b1, "driver_id", ["status"], "2001-07-01", "k", type1=["rating"])
    d2 = scd2_apply(d1, b2, "driver_id", ["status"], "2001-08-01", "k", type1=["rating"])
    rows = sorted((r.driver_id, r.status, r.rating, r.is_current) for r in d2.collect())
    assert rows == [(1, "active", "Medio", True),          # rating updated, no new version
                    (2, "active", "Bajo", False),          # status change closes the old version
                    (2, "inactive", "Alto", True)]


def test_second_change_on_one_day_replaces_the_version(spark):
    schema = "driver_id bigint, status string"
    rows = lambda s: spark.createDataFrame([(1, s)], schema)
    stored = lambda d: spark.createDataFrame(d.collect(), d.schema)
    d = stored(scd2_apply(None, rows("a"), "driver_id", ["status"], "2001-07-01", "k"))
    d = stored(scd2_apply(d, rows("b"), "driver_id", ["status"], "2001-08-01", "k"))
    d = stored(scd2_apply(d, rows("c"), "driver_id", ["status"], "2001-08-01", "k"))
    got = sorted((r.status, str(r.valid_from), r.is_current) for r in d.collect())
    assert got == [("a", "2001-07-01", False), ("c", "2001-08-01", True)]
    assert d.select("k").distinct().count() == 2
    d = stored(scd2_apply(d, spark.createDataFrame([(1, None)], schema), "driver_id", ["status"], "2001-09-01", "k"))
    assert scd2_apply(d, spark.createDataFrame([(1, None)], schema), "driver_id", ["status"], "2001-10-01", "k").count() == 3


def test_point_in_time_is_one_pass(spark):
    """Many versions and facts of one key, gaps, days that begin and end versions, NULLs."""
    import random
    rng = random.Random(4)
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=n)
    versions, k = [], 0
    for key, n in ((1, 1000), (2, 5), (3, 1)):
        at = rng.randrange(40)
        for _ in range(n):
            end = at + rng.randint(1, 3)
            k += 1
            versions.append((key, k, day(at), day(end)))
            at = end + rng.choice([0, 0, 1, 40])
    dim = spark.createDataFrame(versions, "id bigint, sk bigint, valid_from date, valid_to date").repartition(3)
    rows = [(i, rng.choice([1, 1, 1, 2, 3, 4, None]), None if i % 50 == 9 else dt.datetime(2000, 1, 1) + dt.timedelta(hours=rng.randrange(-500, 60_000)))
            for i in range(4000)]
    facts = spark.createDataFrame(rows, "fact int, id bigint, at timestamp_ntz").repartition(5)
    got = {r.fact: r.sk for r in point_in_time(facts, dim, "id", "at", "sk").collect()}
    held = {}
    for key, sk, a, b in versions:
        for n in range((b - a).days):
            held[key, a + dt.timedelta(days=n)] = sk
    assert got == {i: held.get((key, at and at.date()), -1) for i, key, at in rows}
    plan = point_in_time(facts, dim, "id", "at", "sk")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
