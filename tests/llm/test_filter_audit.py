import itertools
import random
import re
from bisect import bisect_right
from collections import Counter

import pytest

from convoy.llm import filter_audit
from convoy.llm.text_ranges import bounds
from convoy.llm.text_trie import Trie


def failed(text):
    w = re.findall("[^ \t-\r]+", text)
    return "".join(f for f, x in zip("ABCD", (
        len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        re.search("[#$%&*|]", text))) if x)


def brute(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    rows = [(lang or "", failed(t or "") + ("E" if i is not None and i > least[t or ""] else ""),
             any(x == i and q == 1 for x, q, _ in labels if x is not None),
             any(x == i and v == 1 for x, _, v in labels if x is not None)) for i, t, lang in docs]
    out = {}
    shapley = Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {r[0] for r in rows}:
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                hit = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                out[part, order, step] = [len(left), len(hit), sum(f in r[1] for r in gone), sum(r[0] == part and r[1] == f for r in rows),
                                          sum(r[2] for r in hit), sum(r[3] for r in hit)]
                gone += hit
                shapley[part, f] += len(hit)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def made():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.choice([3, 150, 250, 600]))) for _ in range(40)]
    texts += ["WORD " * 300, "é" * 97 + "ABC", "é" * 96 + "ABC ", "a|b", "", None, "\x1c", "same header " * 50 + "1", "same header " * 50 + "2"]
    texts += [" ".join(words[:200]), " ".join(words[:100] * 2), " ".join(words[:99] * 2 + ["w0", "w1"]), "x " * 30_000]
    docs = [(i, t, rng.choice(["en", "de", "", None])) for i, t in enumerate(texts)]
    docs += [(1000 + i, rng.choice(texts), rng.choice(["en", "de"])) for i in range(150)]
    docs += [(None, "", "en"), (None, texts[0], None), (None, "only here", "de"), (-7, texts[1], "en")]
    docs += [(2000, texts[2], "en"), (2000, texts[2], "de"), (2000, "other text", "en"), (3000 + 5, "a|b", "fr")] * 2
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 2001, 3)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    rng.shuffle(docs)
    return docs, labels


@pytest.mark.parametrize("full", [1, 32_000_000])
def test_equals_brute_force(spark, full):
    docs, labels = made()
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, lang string, part string, mask int").repartition(5)
    la = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.audit(d, la, full=full).collect()}
    assert got == brute(docs, labels)


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string, lang string")
    la = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(d, la).count() == 0
    one = spark.createDataFrame([(None, None, None)], "doc_id long, text string, lang string")
    got = filter_audit.audit(one, la).collect()
    assert len(got) == 600 and {r.part for r in got} == {""}
    assert {(r.filter_order[r.step - 1], r.shapley) for r in got} == {("A", 120), ("B", 0), ("C", 0), ("D", 0), ("E", 0)}


def test_copies_travel_once_a_task(spark):
    """A text that a third of the rows hold goes through the shuffle once for each task."""
    d = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN repeat('copy ', 200) ELSE concat('text ', id) END AS text",
                                     "'en' AS lang").repartition(4)
    limits = {"words": 200, "distinct": 50, "capitals": 3, "symbols": b"#"}
    first = d.selectExpr("doc_id", "lang AS part", "text").mapInArrow(filter_audit._masks_of(limits, [], 8, 10**9), filter_audit._MASKS_DDL)
    rows = first.collect()
    assert len(rows) == 3000 and sum(r.text is not None and bytes(r.text).startswith(b"copy") for r in rows) <= 4
    assert {r.n for r in filter_audit.masks(d).filter("mask >= 16").collect()} == {1}
    assert filter_audit.masks(d).filter("mask >= 16").count() == 999


def test_bounds_tell_apart_behind_a_long_shared_beginning(spark):
    head = "the same header of every text " * 400
    texts = [head + str(i) for i in range(3000)] + [f"{i} free" for i in range(1000)] + ["copy"] * 5000 + [None, "", head]
    rng = random.Random(2)
    rng.shuffle(texts)
    cuts = bounds(spark.createDataFrame([(t,) for t in texts], "t string").repartition(6), "t", 16)
    assert cuts == sorted(set(cuts)) and 5 <= len(cuts) <= 40
    held = Counter(bisect_right(cuts, t.encode()) for t in set(texts) - {None})
    assert max(held.values()) <= 4003 / 3  # the header alone is shared by 3,000
    assert bounds(spark.createDataFrame([], "t string"), "t", 16) == []
    assert bounds(spark.createDataFrame([("a",), ("a",), (None,)], "t string"), "t", 16) == []


def test_trie_keeps_texts_and_least_ids():
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab", k=rng.randint(0, 12))).encode() for _ in range(500)] + [b"x" * 5000, b"x" * 4999 + b"y"]
    trie, want = Trie(), {}
    for i, t in enumerate(texts):
        trie.insert(t, -i, i)
        want.setdefault(t, []).append((-i, i))
    got = list(trie.terminals())
    assert [g[0] for g in got] == sorted(want) and all(rows == want[t] and least == min(rows)[0] for t, least, rows in got)
    assert trie.size < sum(map(len, want))
