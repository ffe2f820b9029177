import hashlib
import random
import zlib

from convoy.llm.prefix_trie import trie
from convoy.llm.running import running
from pyspark.sql import functions as F


def brute(rows, block=20, share=4):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % share
        built[c] = tuple(own.get(c - c % block, [])[:h] + v[h:])
    members, ends = {}, {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
        ends.setdefault(s, []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in sorted(members, key=len, reverse=True):  # children before parents
        leaves[p] = leaves.get(p, 0) or 1
        saved[p] = saved.get(p, 0) + (len(members[p]) - 1) * (len(p[-1][1].encode().split()) if p else 0)
        if p:
            for total, own in ((kids, 1), (leaves, leaves[p]), (saved, saved[p])):
                total[p[:-1]] = total.get(p[:-1], 0) + own
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in members.items()),
                  key=str)


def check(spark, rows, n=5):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, depth string, words int")
    got = trie(df.repartition(n)).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_equals_brute_force(spark):
    rng = random.Random(9)
    texts = ["hi", "hi there", "", None, "a\x0bb c", "long " * 3000, "\xa0 x"]
    rows = []
    for c in [*range(0, 20), *range(21, 60), *range(100, 130), 20_000, 20_003, 7_000_000_019]:
        n = rng.choice([1, 1, 2, 3, 5, 8])
        rows += [(c, rng.choice([t, t, None]), rng.choice(["user", "user", None]), rng.choice(texts)) for t in range(n)]
    rows += [(None, 0, "user", "nobody"), (40, 1, "user", "hi"), (40, 1, "user", "hi"), (41, 1, "b", "tie"), (41, 1, "a", "tie"), (41, 1, "a", "ti")]
    rng.shuffle(rows)
    check(spark, rows)


def test_hot_keys(spark):
    """One conversation of many turns, one repeated turn, one sequence that very many share."""
    rows = [(60, t, "user", f"turn {t % 50}") for t in range(3000)] + [(61, 5, "user", "again")] * 2000
    rows += [(c, 0, "user", "the same") for c in range(1000, 21_000)]
    rows += [(100_000 + c, t, "user", "first" if not t else f"t{c}") for c in range(300) for t in range(5)]
    check(spark, rows, 6)


def test_no_rows(spark):
    assert trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert trie(spark.createDataFrame([(None, 1, "a", "b")], "conv_id long, turn long, role string, text string")).count() == 0


def test_running_crosses_partitions(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 5, 9]), i, rng.getrandbits(62) - 2 ** 61, rng.randint(-5, 5)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, at long, x long, y long").repartition(5)
    got = {(r.k, r.at): (r.n, r.run_x, r.run_y) for r in running(df, "k", [F.col("at")], ["at"], xor=["x"], add=["y"]).collect()}
    want, state = {}, {}
    for k, at, x, y in sorted(rows):
        n, a, b = state.get(k, (0, 0, 0))
        want[k, at] = state[k] = (n + 1, a ^ x, b + y)
    assert got == want
