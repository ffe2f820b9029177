import numpy as np

from convoy.llm import ann


def _table(spark, x, ids):
    return spark.createDataFrame([(int(i), None if v is None else [None if c is None else float(c) for c in v], "r") for i, v in zip(ids, x)],
                                 "vec_id long, embedding array<float>, rank string")


def brute(x, ids, q, k):
    d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
    d[q] = np.inf
    o = np.lexsort((ids, d))[:k]
    return [(int(ids[i]), d[i]) for i in o if np.isfinite(d[i])]


def test_recall_and_exact_scores(spark):
    r = np.random.default_rng(2)
    centre = r.normal(size=(40, 16))
    x = (centre[r.integers(0, 40, 3000)] + 0.25 * r.normal(size=(3000, 16))).astype(np.float32)
    x[1000:1400] = x[1000]  # a crowd of equal vectors
    ids = np.arange(3000) * 3
    df = _table(spark, x, ids)
    got = {}
    for row in ann.search(df, df.filter("vec_id % 100 = 0"), "vec_id", "embedding", 10, ann.Params(block=200)).collect():
        got.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    hit = 0
    queries = [i for i in range(3000) if ids[i] % 100 == 0]
    for q in queries:
        want, own = brute(x, ids, q, 10), sorted(got[int(ids[q])])
        assert [a for a, _, _ in own] == list(range(1, 11))
        hit += len({v for v, _ in want} & {v for _, v, _ in own})
        where = {int(v): i for i, v in enumerate(ids)}
        for _, v, s in own:
            assert abs(s - np.sqrt(((x[where[v]].astype(float) - x[q].astype(float)) ** 2).sum())) < 1e-12
    assert len(got) == len(queries) and hit >= 0.9 * 10 * len(queries)


def test_bad_vectors_ties_and_small_tables(spark):
    x = [[1, 0], [0, 0], None, [1, None], [float("nan"), 1], [float("inf"), 1], [1, 0], [2, 0], [0.5, 0, 0], [1, 0]]
    df = _table(spark, x, [0, 1, 2, 3, 4, 5, 9, 7, 8, 6])
    got = [(r.rank, r.vec_id, r.score) for r in ann.search(df, df, "vec_id", "embedding", 10).filter("query_id = 0").orderBy("rank").collect()]
    assert got == [(1, 6, 0.0), (2, 9, 0.0), (3, 7, 1.0)]
    none = df.filter("vec_id < 0")
    assert ann.search(none, none, "vec_id", "embedding").count() == 0


def test_partitions_are_balanced():
    x = np.random.default_rng(3).normal(size=(600, 8))
    part = ann.balanced_partition(ann.nearest(x, 8), 6)
    size = np.bincount(part, minlength=6)
    assert size.sum() == 600 and size.max() <= 600 / 6 * 1.15 + 1


def test_an_id_of_several_vectors_asks_with_the_least(spark):
    rows = [(100, [2.0, 1.0]), (100, [1.0, 1.0]), (1, [1.0, 1.1]), (2, [2.0, 1.1]), (3, [9.0, 9.0])]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "vec_id long, embedding array<double>").repartition(2)
        got = ann.search(df, df.filter("vec_id = 100"), "vec_id", "embedding", k=2).orderBy("rank").collect()
        assert [r.vec_id for r in got] == [1, 2]
