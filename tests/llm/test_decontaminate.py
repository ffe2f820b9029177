import random

from convoy.llm import decontaminate as D


def brute(docs, items, n, threshold):
    def grams(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}
    out = set()
    for i, t in docs:
        for k, s in items:
            a, b = grams(s), grams(t)
            if a and i is not None and k is not None and len(a & b) >= threshold * len(a) - 1e-9:
                out.add((i, k, len(a), len(a & b)))
    return out


def test_equals_brute_force(spark):
    r = random.Random(6)
    word = lambda: f"W{r.randrange(300)}"
    items = [(k, " ".join(word() for _ in range(r.randint(1, 60)))) for k in range(40)] + [(50, None), (51, " "), (None, "a b c d e f"), (52, "Solo"), (53, "solo")]
    docs = [(0, None), (1, ""), (2, "SOLO"), (3, "solo one"), (None, items[5][1])]
    for i in range(4, 90):
        w = [word() for _ in range(r.randint(0, 400))]
        s = r.choice(items[:40])[1].split()
        for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
            s[r.randrange(len(s))] = word()
        at = r.randint(0, len(w))
        docs.append((i, " \n".join(w[:at] + s + w[at:])))
    docs.append((8, docs[7][1]))
    a = spark.createDataFrame([(i, t, "h") for i, t in docs], "doc_id long, text string, h string")
    b = spark.createDataFrame([(t, k, "h") for k, t in items], "text string, item_id long, size string")
    seen = {}
    for i, t in docs:  # rows of one id count as one document: the union of their shingles
        seen.setdefault(i, []).append(t)
    one = [(i, t) for i, ts in seen.items() if len(ts) == 1 for t in ts]
    got = {(x.doc_id, x.item_id, x.item_shingles, x.found) for x in D.leaks(a, b).collect() if x.doc_id != 8}
    assert got == brute(one, items, 5, 0.8)
    assert D.leaks(a.filter("doc_id = 999"), b).count() == 0 and D.leaks(a, b.filter("item_id = 999")).count() == 0


def test_sketch_holds_one_more_than_may_be_missing(spark):
    items = spark.createDataFrame([(k, h) for k in range(1, 70) for h in range(k)], "item_id long, h long")
    for r in D.sketches(items, 0.8).groupBy("item_id", "size").agg(D.F.sum(D.F.col("in_sketch").cast("int")).alias("k")).collect():
        missing = r["size"] - -(-8 * r["size"] // 10)
        assert missing + 1 <= r["k"] <= r["size"]
