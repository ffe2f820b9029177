import random

import numpy as np
from pyspark.sql import functions as F

from convoy.llm import mixing as M


def reshared(sizes, weights, share, most):
    """Targets by repeated resharing; sources in order, NULL last."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        unit = left / sum(w[s] for s in open_)
        over = {s for s in open_ if unit * w[s] > most * sizes[s]}
        if not over:
            return full | {s: unit * w[s] for s in open_}
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]
        open_ -= over
    return full


def _docs(spark, n=3000, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        s = r.choice(["b", "b", "b", "a", "é", "Z", None])
        rows.append((i, " ".join(["w"] * int(r.lognormvariate(3, 1))), s, "y"))
    return spark.createDataFrame(rows + [(n, None, "empty", "y"), (n + 1, " ", "empty", "y")], "doc_id long, text string, source string, p string")


def test_targets_words_and_limits(spark, monkeypatch):
    monkeypatch.setattr(M, "GROUP", 64)
    docs = _docs(spark)
    got = M.mix(docs).collect()
    size = {}
    for r in got:
        size[r.source] = size.get(r.source, 0) + r.size
    want = reshared(size, [3, 1, 2], 1.5, 2.0)
    for s in size:
        own = [r for r in got if r.source == s]
        assert all(abs(r.target - want[s]) < 1e-6 * max(1, want[s]) and r.source_size == size[s] for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= max(2, 0.005 * want[s])
        per = want[s] / size[s] if size[s] else 0
        assert all(r.taken == r.copies * r.size and (r.size == 0 or int(per) <= r.copies <= int(per) + 1) for r in own)
    assert len(got) == docs.count() and all(r.taken <= 2 * r.size for r in got)
    again = M.mix(docs.repartition(7, F.rand(3))).collect()
    assert {r.doc_id: r.taken for r in again} == {r.doc_id: r.taken for r in got}


def test_pivotal_keeps_sums_and_expectations():
    p = np.random.default_rng(0).random(50)
    mean = np.zeros(50)
    for seed in range(3000):
        x, at = M.pivotal(p, np.random.default_rng(seed))
        assert abs(x.sum() - p.sum()) < 1e-6 and (((x == 0) | (x == 1)).sum() >= 49)
        mean += x / 3000
    assert np.abs(mean - p).max() < 0.05


def test_apply_repeats_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 1), (1, "a b", "s", 1), (2, "c", "s", 1), (None, "d e f", "s", 1), (3, None, None, 1)],
                                 "doc_id long, text string, source string, size int")
    mixed = M.mix(docs)
    out = M.apply_mix(docs, mixed)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in mixed.collect())
    none = docs.filter("doc_id = 99")
    assert M.mix(none).count() == 0 and M.apply_mix(none, M.mix(none)).count() == 0
