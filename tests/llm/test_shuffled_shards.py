import random
import struct

import pytest
import xxhash

from convoy.llm.shuffled_shards import fisher_yates, write_shards


def hashed(*values, seed=42):
    """Spark's xxhash64 of long, int, bool, string columns (NULL: passed over)."""
    for v in values:
        if v is None:
            continue
        raw = v.encode() if isinstance(v, str) else struct.pack("<i" if isinstance(v, (bool, Int)) else "<q", v)
        seed = xxhash.xxh64_intdigest(raw, seed=seed)
    return seed - 2 ** 64 if seed >= 2 ** 63 else seed


class Int(int):
    """A 32-bit value."""


def brute(rows, shards, seed, bucket):
    seen, keyed, size = {}, [], 0
    for r in rows:
        every = [x for v in r for x in (v is None, v)]
        h = [hashed(Int(seed), Int(i), *every) for i in range(2)]
        copy = seen[r] = seen.get(r, -1) + 1
        keyed.append((h[0] if not copy else hashed(*h, copy), h[1], copy, r))
        size += len((r[1] or "").encode()) + 1
    buckets = max(1, -(-size // bucket))
    held = {}
    for k in sorted(keyed, key=lambda k: (k[0] % buckets, k[0], k[1], k[2])):
        held.setdefault(k[0] % buckets, []).append(k[3])
    order = [held[b][i] for b in sorted(held) for i in fisher_yates(len(held[b]), [seed, b])]
    out, place = {}, 0
    for s in range(shards):
        n = -(-len(rows) * (s + 1) // shards) - -(-len(rows) * s // shards)
        out.update({(s, i): order[place + i] for i in range(n)})
        place += n
    return out


def made():
    rng = random.Random(4)
    rows = [(i, rng.choice(["", "x", "äö " * rng.randint(0, 300), None]), rng.choice(["a", None]), None) for i in range(400)]
    rows += [(None, "same", "a", "s")] * 150 + [(7, None, None, None)] * 3 + [(-5, "z" * 200_000, "a", ""), (5, "b", None, "a"), (5, "b", "a", None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bucket", [3000, 16_000_000])
def test_equals_brute_force(spark, tmp_dir, bucket):
    rows = made()
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot string")
    want = brute(rows, 5, 12, bucket)
    for n in (1, 6):
        got = write_shards(df.repartition(n), f"{tmp_dir}/s{n}", shards=5, bucket=bucket).collect()
        assert {(r.shard, r.slot): tuple(r.record) for r in got} == want and len(got) == len(rows)


def test_law_and_order(spark, tmp_dir):
    df = spark.range(1003).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'copy' ELSE concat('text ', id) END AS text")
    got = write_shards(df, f"{tmp_dir}/s", shards=16, bucket=2000).collect()
    held = {}
    for r in got:
        held.setdefault(r.shard, []).append((r.slot, r.record.doc_id))
    assert sorted(held) == list(range(16)) and {len(v) for v in held.values()} == {62, 63}
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in held.values())
    assert sorted(i for v in held.values() for _, i in v) == list(range(1003))
    # the order says nothing about the id: neighbours are no closer than chance
    ids = [i for s in sorted(held) for _, i in sorted(held[s])]
    gap = sum(abs(a - b) for a, b in zip(ids, ids[1:])) / (len(ids) - 1)
    assert 0.85 < gap / (1003 / 3) < 1.15


def test_files_hold_slots_in_order(spark, tmp_dir):
    df = spark.range(500).selectExpr("id AS doc_id", "repeat('t', 50) AS text")
    write_shards(df, f"{tmp_dir}/s", shards=3, bucket=4000)
    import glob

    import pyarrow.parquet as pq
    for f in glob.glob(f"{tmp_dir}/s/shard=*/*.parquet"):
        slots = pq.read_table(f, columns=["slot"], partitioning=None)["slot"].to_pylist()
        assert slots == sorted(slots)


def test_few_or_no_rows(spark, tmp_dir):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert write_shards(none, f"{tmp_dir}/none").count() == 0
    two = spark.createDataFrame([(None, None), (None, None)], "doc_id long, text string")
    assert sorted((r.shard, r.slot) for r in write_shards(two, f"{tmp_dir}/two", shards=4).collect()) == [(0, 0), (2, 0)]


def test_fisher_yates():
    assert fisher_yates(0, [1]) == [] and fisher_yates(1, [1]) == [0]
    seen = {tuple(fisher_yates(3, [7, i])) for i in range(200)}
    assert len(seen) == 6 and fisher_yates(50, [1, 2]) == fisher_yates(50, [1, 2])
