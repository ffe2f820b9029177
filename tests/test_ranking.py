import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from convoy.operators.ranking import with_ranks


def test_distributed_rank_equals_window_rank(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([None, *range(40)]) if i % 9 else None, rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, v int, w double")
    got = with_ranks(df, [("v", "r_asc", True), ("v", "r_desc", False), ("w", "rw", True)])
    want = df.select(
        "id",
        F.rank().over(Window.orderBy(F.col("v").asc_nulls_last())).alias("r_asc"),
        F.rank().over(Window.orderBy(F.col("v").desc_nulls_first())).alias("r_desc"),
        F.rank().over(Window.orderBy("w")).alias("rw"))
    g = {r.id: (r.r_asc, r.r_desc, r.rw) for r in got.select("id", "r_asc", "r_desc", "rw").collect()}
    w = {r.id: (r.r_asc, r.r_desc, r.rw) for r in want.collect()}
    assert g == w


def test_rank_on_empty_input(spark):
    df = spark.createDataFrame([], "id int, v double")
    assert with_ranks(df, [("v", "r", True)]).count() == 0


def test_no_global_window(spark):
    df = spark.range(500).selectExpr("id", "cast(id % 7 as double) AS v", "cast(id AS double) AS w")
    got = with_ranks(df, [("v", "a", True), ("w", "b", False)], row_key="id")
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
