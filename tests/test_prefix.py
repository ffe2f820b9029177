import random

from pyspark.sql import functions as F

from convoy.operators.prefix import row_numbers, running_totals


def test_row_numbers_follow_the_order(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 2, 2, rng.randint(0, 50)]), i, "x") for i in range(3000)]
    df = spark.createDataFrame(rows, "v int, id int, _pid string").withColumnRenamed("_pid", "extra").repartition(7)
    got = row_numbers(df, [F.col("v").asc_nulls_last(), F.col("id")]).collect()
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [(r.v, r.id) for r in sorted(got, key=lambda r: r.row_number)] == [w[:2] for w in want]
    assert sorted(r.row_number for r in got) == list(range(1, 3001))


def test_running_totals(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS w", "-id AS z").repartition(5)
    got = running_totals(df, [F.col("id").desc()], {"w": "w_before", "z": "z_before"}, "n").collect()
    w = z = 0
    for n, r in enumerate(sorted(got, key=lambda r: -r.id), 1):
        assert (r.n, r.w_before, r.z_before) == (n, w, z)
        w, z = w + r.w, z + r.z
    assert running_totals(df.limit(0), [F.col("id")], {"w": "b"}).count() == 0


def test_no_global_window(spark):
    df = spark.range(100)
    for out in (row_numbers(df, [F.col("id")]), running_totals(df, [F.col("id")], {"id": "b"})):
        assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
