import hashlib
import random

import numpy as np
import pytest

from convoy.llm import suffix_dedup as S


def brute(rows, length):
    first, out = {}, []
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            first[w] = min(first.get(w, S.LAST), S.LAST if i is None else i)
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < (S.LAST if i is None else i):
                gone[p:p + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest(), kept))
    return out


def rows_of(seed, length):
    r = random.Random(seed)
    passages = ["".join(r.choice("abé ") for _ in range(r.randint(length - 3, 3 * length))) for _ in range(6)]
    rows = []
    for i in range(60):
        t = ""
        for _ in range(r.randint(0, 4)):
            t += "".join(r.choice("abcdefgh é") for _ in range(r.randint(0, length)))
            if r.random() < 0.6:
                p = r.choice(passages)
                t += p[r.randint(0, 4):len(p) - r.randint(0, 4)]
        rows.append((r.randrange(1000) * 2, t))
    rows += [(5, "ab" * 90), (4, "ab" * 70), (3, "x" * 200), (9, "x" * 49), (11, "x" * 50), (13, None), (15, "")]
    return list(dict(rows).items()) + [(7001, rows[0][1]), (7003, rows[0][1]), (None, passages[0] + passages[1])]


@pytest.mark.parametrize("seed,length", [(1, 50), (2, 24), (3, 31)])
def test_equals_brute_force(spark, monkeypatch, seed, length):
    monkeypatch.setattr(S, "SHARD_BYTES", 700)
    rows = rows_of(seed, length)
    df = spark.createDataFrame([(t, i, "z") for i, t in rows], "text string, doc_id long, rid string").repartition(5)
    key = lambda r: (r[0] is None, r[0] or 0, r[4])
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in S.remove_repeats(df, length, keep_text=True).collect()]
    assert sorted(got, key=key) == sorted(brute(rows, length), key=key)


@pytest.mark.parametrize("length", [50, 16, 17])
def test_hot_anchors_are_parted_without_losing_windows(spark, length):
    r = random.Random(length)
    noise = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    phrase, passage = "of the united states of america", "a passage that many documents share, each within words of its own."
    rows = rows_of(4, length) + [(10_000 + i, noise(60) + (phrase if i % 3 else passage) + noise(60)) for i in range(150)]
    rows += [(20_000 + i, noise(9) + phrase + " is the same everywhere, as are these") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    key = lambda x: (x[0] is None, x[0] or 0, x[4])
    want = sorted(brute(rows, length), key=key)
    for places in (1, 40):
        got = [(x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256, bytes(x.kept))
               for x in S.remove_repeats(df, length, keep_text=True, hot_places=places).collect()]
        assert sorted(got, key=key) == want


def test_parted_places_of_one_anchor_lie_apart():
    texts = [b"left %02d|common anchor 16|right %02d" % (i % 7, i % 5) * 2 for i in range(100)]
    buf, start, _ = S.layout(texts, 50)
    at = start + texts[0].index(b"common")
    row, side, key = S._parted(buf, at, np.full(100, 5 | S.HOT_BIT), 8)
    assert sorted(side.tolist()) == [1] * 100 + [2] * 100
    assert len(set(key[side == 1])) == 1 and len(set(key[side == 2])) == 7  # "|rig" follows all, five bytes stand before


def test_hot_copies_are_found_apart(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT_SHARE", 4)
    rows = [(i, "a text that is copied very many times over, word for word") for i in range(40, 0, -1)]
    rows += [(100 + i, "another text with only two copies of it in this whole table %d" % (i // 2)) for i in range(20)]
    got = {x.doc_id: x.n_removed for x in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {r[0]: r[2] for r in brute(rows, 50)}


def test_repeated_rows_and_empty_table(spark):
    t = "the same long passage stands here twice, in one document only. " * 2
    df = spark.createDataFrame([(1, t), (1, t), (2, "q" + t[:55])], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed, r.n_spans) for r in S.remove_repeats(df).collect())
    assert got == [(1, 0, 0), (1, 0, 0), (2, 55, 1)]
    assert S.remove_repeats(df.filter("doc_id = 9")).count() == 0


def test_radix_groups_are_the_repeated_suffixes():
    r = np.random.default_rng(1)
    group, doc = r.integers(0, 3, 400), r.integers(0, 9, 400)
    digits = [r.integers(0, 3, 400).astype(np.uint64) for _ in range(3)]
    keys = list(zip(group, *digits))
    want = [i for i in range(400) if doc[i] > min(doc[j] for j in range(400) if keys[j] == keys[i])]
    assert sorted(S.radix_repeats(group, digits, doc)) == want
