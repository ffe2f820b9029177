import random

from convoy.llm.components import connected_components


def test_equals_union_find(spark):
    r = random.Random(4)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(300, i) for i in range(301, 340)] + [(i, i + 1) for i in range(400, 440)]
    edges += [(5, 5), (None, 3), edges[0], edges[0][::-1]]
    root = {x: x for e in edges if None not in e for x in e}
    for _ in range(60):
        for a, b in edges:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    want = {k: v for k, v in root.items() if any(k in e and e[0] != e[1] and None not in e for e in edges)}
    got = {x.node: x.root for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
