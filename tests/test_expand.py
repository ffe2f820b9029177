from convoy.operators.expand import allocate, expand_range


def test_expand_range_across_chunks(spark):
    df = spark.createDataFrame([(1, 10), (2, 0), (3, 1), (4, 25)], "k int, n int")
    out = expand_range(df, "n", "i", keys=["k"], chunk=4)
    got = sorted((r.k, r.i) for r in out.collect())
    want = sorted([(1, i) for i in range(10)] + [(3, 0)] + [(4, i) for i in range(25)])
    assert got == want


def test_allocate_proportional_with_floor(spark):
    df = spark.createDataFrame([(1, 1.0, 100.0), (1, 3.0, 100.0), (2, 0.0, 10.0), (2, 1000.0, 10.0)],
                               "g int, w double, total double")
    out = {(r.g, r.w): r.a for r in allocate(df, ["g"], "w", "total", "a", 0.95, 0.5).collect()}
    assert out[(1, 1.0)] == 23.75 and out[(1, 3.0)] == 71.25
    assert out[(2, 0.0)] == 0.5 and out[(2, 1000.0)] == 9.5
