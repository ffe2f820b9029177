import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from convoy.llm import ngram_join as J


def _set(t, n):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def brute(texts, n, percent):
    sets = {i: _set(t, n) for i, t in texts}
    root, links = {i: i for i in sets}, dict.fromkeys(sets, 0)
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            x, y = root[a], root[b]
            root = {k: min(x, y) if v in (x, y) else v for k, v in root.items()}
    return {i: (len(sets[i]), root[i], links[i]) for i in sets}


def variants(seed, groups, copies, words):
    r, out = random.Random(seed), []
    for _ in range(groups):
        base = [f"w{r.randrange(5000)}" for _ in range(r.randint(*words))]
        for _ in range(copies):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4, 9])):
                w[r.randrange(len(w))] = f"v{r.randrange(9999)}"
            out.append(" ".join(w))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("n,percent,words,copies", [(4, 85, (3, 60), 9), (5, 80, (150, 260), 60)])
def test_equals_brute_force(docs_of, n, percent, words, copies):
    texts = variants(n, 9, copies, words) + [None, "", " \t", "One two", "one  TWO", "one two", "é x", "É x"]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in J.join(docs_of(texts, 100), n, percent).collect()}
    assert got == brute([(100 + i, t) for i, t in enumerate(texts)], n, percent)


def test_large_group_spans_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 8)
    texts = variants(7, 2, 40, (60, 90))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in J.join(docs_of(texts), 4, 85).collect()}
    assert got == brute(list(enumerate(texts)), 4, 85)


def test_similar_sets_share_a_signature():
    bands, r = J.Bands(85), np.random.default_rng(1)
    for size in [*range(1, 40), 100, 400, 3000]:
        for _ in range(12):
            a = r.integers(0, 1 << 62, size).astype(np.uint64)
            cut, add = r.integers(0, size // 6 + 1), r.integers(0, size // 6 + 1)
            b = np.unique(np.r_[a[cut:], r.integers(0, 1 << 62, add).astype(np.uint64)])
            a = np.unique(a)
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both) and both < max(len(a), len(b)):
                x, y = J.signatures([a, b], bands)
                assert len(np.intersect1d(x, y)), (len(a), len(b), both)


def test_shingles_of_a_slice():
    texts = pa.array(["a b c d e", None, "x", "a b c d e ÄB"])
    assert [len(s) for s in J.shingle_sets(texts.slice(1), 4)] == [0, 1, 3]


def test_null_ids_and_empty_table(spark):
    schema = "text string, doc_id long, key string"
    rows = [("a b c d e", None, "k"), ("a b c d e", 7, "k"), ("a b c d e", 7, "k"), (None, None, None)]
    got = sorted((r.doc_id is None, r.component_id, r.n_links) for r in J.join(spark.createDataFrame(rows, schema)).filter("n_shingles > 0").collect())
    assert got == [(False, 7, 2), (False, 7, 2), (True, 7, 2)]
    assert J.join(spark.createDataFrame([], schema)).count() == 0


def test_links_of_rows_without_an_id_and_of_repeated_rows(spark):
    w = [f"w{i}" for i in range(60)]
    texts = [" ".join(w), " ".join([*w[:-1], "x"])]
    rows = [(None, texts[0]), (None, texts[1]), (4, texts[0].replace("w", "v")), (4, texts[0].replace("w", "v")), (5, texts[1].replace("w", "v")), (4, "unlike all that")]
    got = {(r.doc_id, r.n_shingles > 3, r.component_id, r.n_links) for r in J.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {(None, True, None, 1), (4, True, 4, 2), (5, True, 4, 2), (4, False, 4, 0)}


def test_partitions_of_few_elements_are_left_out():
    bands, r = J.Bands(85), np.random.default_rng(3)
    sets = [np.unique(np.r_[np.uint64(77), r.integers(0, 1 << 62, 199).astype(np.uint64)]) for _ in range(1500)]
    sig, n = np.unique(np.concatenate(J.signatures(sets, bands)), return_counts=True)
    assert n.max() <= 12  # sets that one common shingle joins: 23 when it counts alone


def test_nodes_that_only_share_a_signature_connect_nothing(spark):
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 1 << 62, 200).astype(np.uint64)) for _ in range(41)]
    sets[40] = sets[39].copy()
    sets[40][0] += np.uint64(1)
    cells = spark.createDataFrame([(i, J.histogram(s)) for i, s in enumerate(sets)], "node long, cells binary")
    shared = spark.createDataFrame([(m, i) for m in (1, 2) for i in range(m - 1, 41)], "met long, node long")
    assert {(x.node, x.root) for x in J._candidates(shared, cells, 85, 3).collect()} == {(39, 39), (40, 39)}


def test_intersections_of_blocks(monkeypatch):
    r = np.random.default_rng(0)
    for often, columns, stretch in [(3, 4, 50), (48, 2048, 2_000_000), (1, 2, 10), (1000, 5, 1)]:
        for name, x in [("OFTEN", often), ("COLUMNS", columns), ("STRETCH", stretch)]:
            monkeypatch.setattr(J, name, x)
        for _ in range(20):
            left, right = ([np.unique(r.integers(0, 40, r.integers(1, 30)).astype(np.uint64)) for _ in range(r.integers(1, 20))] for _ in range(2))
            assert (J.common(left, right) == [[len(np.intersect1d(a, b)) for b in right] for a in left]).all()


def test_blocks_of_texts_and_of_histograms(docs_of, monkeypatch):
    for name, x in [("BLOCK", 7), ("STEP_SHINGLES", 300), ("BATCH_BYTES", 500), ("TEXT_BLOCK", 16), ("BLOCK_SHINGLES", 900), ("CELL_BLOCK", 8)]:
        monkeypatch.setattr(J, name, x)
    texts = variants(8, 2, 40, (60, 90))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in J.join(docs_of(texts), 4, 85).collect()}
    assert got == brute(list(enumerate(texts)), 4, 85)


def test_nodes_of_a_signature_travel_once(spark):
    group = spark.range(3000).selectExpr("1L met", "id node", "id comp")
    assert J._block_pairs(group).count() == 3000  # 9000 in blocks of 1024


def test_histograms_of_all_widths():
    r = np.random.default_rng(2)
    counts = [np.bincount(r.integers(0, 64, n), minlength=64) for n in (3, 64 * 250, 64 * 300)]
    sets = [r.integers(0, 1 << 62, n).astype(np.uint64) for n in (0, 3, 900, 64 * 230, 64 * 400)]
    raw = [J.histogram(s) for s in sets] + [c.astype("<u4").tobytes() for c in counts]
    got = J.histograms(raw)
    assert got.sum(1).tolist() == [*map(len, sets), *(c.sum() for c in counts)]
    assert (got[-3:] == counts).all() and len(raw[1]) == 64 and len(raw[4]) == 128


def test_steps_hold_bounded_elements():
    r = np.random.default_rng(8)
    size, at = r.integers(1, 90, 300), r.permutation(300)[:200]
    got = J._steps(at, size, 9, 500)
    assert np.concatenate(got).tolist() == at.tolist()
    assert all(len(x) <= 9 and (size[x].sum() <= 500 or len(x) == 1) for x in got) and max(map(len, got)) == 9
    assert J._steps(at[:0], size, 9, 200) == [] and [len(x) for x in J._steps(at, size, 9, 0)] == [1] * 200
