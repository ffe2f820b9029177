import datetime as dt
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from convoy.operators.key_index import files_holding, files_with, key_blocks, key_rows, merged
from convoy.plans import batches as B
from convoy.plans import manifest
from test_warehouse import S, _at, _fleet

ALL = ("2001-07-30 00:00:00", "2001-08-10 00:00:00")


def _run(spark, out, rows, batch, window=ALL, as_of=None):
    return B.run_daily(spark, _fleet(spark, rows), out, as_of or f"2001-08-0{batch} 00:00:00", batch, *window)


def _facts(spark, out):
    return {r.delivery_id: (r.date_key, r.etl_batch_id) for r in B.stored(spark, out)["fact_deliveries"].collect()}


def _moved(row, days):
    return (*row[:6], row[6] + dt.timedelta(days=days), row[7] + dt.timedelta(days=days), *row[8:])


def test_a_delivery_whose_day_changed_is_stored_once(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(B, "ROWS_A_FILE", 3)
    out = os.path.join(tmp_dir, "wh")
    rows = [_moved(_at(11, i), i // 3) for i in range(1, 10)]
    _run(spark, out, rows, 1)
    before = manifest.current(spark, out)
    assert len(before.files) >= 3
    day = lambda k: {r.date_key: r.total_deliveries for r in B.stored(spark, out)["daily_totals"].collect()}.get(k)
    assert day(20010801) == 3 and day(20010731) == 2
    _run(spark, out, [_moved(rows[4], -1), _at(12, 20)], 2)  # number 5 of 2001-08-01, one day earlier
    facts = _facts(spark, out)
    assert facts[5] == (20010731, 2) and len(facts) == 10 == B.stored(spark, out)["fact_deliveries"].count()
    (c,) = B.stored(spark, out)["dim_customer"].collect()
    assert c.total_deliveries == 10
    assert day(20010801) == 2 and day(20010731) == 4  # both days were rolled up again
    # only the file that held the delivery was rewritten
    after = manifest.current(spark, out)
    gone = set(before.files) - set(after.files)
    held = spark.read.parquet(*before.files).select("delivery_id", F.col("_metadata.file_path").alias("file"))
    assert gone == {r.file for r in held.where("delivery_id = 5").collect()}
    # a correction back to the first values is one more version
    _run(spark, out, [rows[4]], 3)
    assert _facts(spark, out)[5] == (20010801, 3) and day(20010731) == 3


def test_an_unchanged_delivery_stays(spark, tmp_dir):
    out = os.path.join(tmp_dir, "wh")
    _run(spark, out, [_at(11, 1), _at(12, 2)], 1)
    files = manifest.current(spark, out).files
    m = _run(spark, out, [_at(11, 1), _at(13, 3)], 2)
    assert _facts(spark, out) == {1: (20010731, 1), 2: (20010731, 1), 3: (20010731, 2)} and m["records_loaded"] == 1
    assert set(files) < set(manifest.current(spark, out).files)


def _named(i, name, hours=11):
    r = _at(hours, i)
    return (*r[:3], name, *r[4:])


def _tables(spark, out):
    t = B.stored(spark, out)
    return {n: sorted(map(str, t[n].drop("etl_timestamp").collect())) for n in ("fact_deliveries", "dim_customer", "dim_driver",
                                                                              "dim_vehicle", "dim_date")}


def test_batches_in_any_order(spark, tmp_dir):
    one = [_named(1, "C1"), _named(2, "C2")]
    two = [_named(2, "C2"), _moved(_named(3, "C3"), 3), _named(1, "C9", 13)]
    steps = {1: one, 2: two}
    outs = [os.path.join(tmp_dir, n) for n in ("in", "re")]
    for b in (1, 2):
        _run(spark, outs[0], steps[b], b)
    for b in (2, 1, 2):
        _run(spark, outs[1], steps[b], b)
    want = _tables(spark, outs[0])
    assert _tables(spark, outs[1]) == want and len(want["fact_deliveries"]) == 3 and len(want["dim_date"]) == 4
    # a rerun of the first batch with a further delivery of a new customer
    _run(spark, outs[0], [*one, _named(7, "C7")], 1)
    t = B.stored(spark, outs[0])
    assert {r.customer_name: r.total_deliveries for r in t["dim_customer"].collect()} == {"C2": 1, "C3": 1, "C9": 1, "C7": 1}
    assert t["dim_date"].count() == 4 and B.stored_views(spark, outs[0])["v_sales"].count() == 4
    # a rerun without the corrected delivery brings the first version back
    _run(spark, outs[0], two[:2], 2)
    assert {r.customer_name for r in B.stored(spark, outs[0])["dim_customer"].collect()} == {"C1", "C2", "C3", "C7"}
    # and an empty rerun takes the batch away
    _run(spark, outs[0], [], 2)
    assert _facts(spark, outs[0]) == {1: (20010731, 1), 2: (20010731, 1), 7: (20010731, 1)}


def test_a_reader_keeps_its_version(spark, tmp_dir):
    out = os.path.join(tmp_dir, "wh")
    _run(spark, out, [_at(11, 1)], 1)
    old = B.stored(spark, out)["fact_deliveries"]
    _run(spark, out, [_moved(_at(11, 1), 1), _at(12, 2)], 2)
    assert [r.date_key for r in old.collect()] == [20010731]
    assert sorted(_facts(spark, out).values()) == [(20010731, 2), (20010801, 2)]
    # a version without its marker was never published
    os.makedirs(f"{out}/manifest/version=00000099")
    assert len(_facts(spark, out)) == 2
    _run(spark, out, [_at(15, 3)], 3)
    assert len(_facts(spark, out)) == 3


def test_only_empty_batches(spark, tmp_dir):
    out = os.path.join(tmp_dir, "wh")
    assert B.stored(spark, out) == {}
    m = _run(spark, out, [], 1)
    assert m["records_extracted"] == 0 and B.stored(spark, out) == {}
    rejected = [(1, 1, "F", "Ana", "x, B", D("0.00"), S, S, "delivered", True)]
    assert _run(spark, out, rejected, 2)["records_loaded"] == 0
    t = B.stored(spark, out)
    assert t["fact_deliveries"].count() == 0 and t["dim_customer"].count() == 0 and t["dim_driver"].count() == 1


@pytest.mark.parametrize("ids", [range(100), [-5, 0, 1, 32767, 32768, 32769, 10 ** 15, -10 ** 15]])
def test_key_index_is_exact(spark, ids):
    rows = [(f"f{i % 3}", k) for i, k in enumerate(ids)] + [("f9", None)]
    index = key_blocks(spark.createDataFrame(rows, "file string, k long"), "k", "file")
    for i, k in enumerate(ids):
        blocks = merged([key_blocks(spark.createDataFrame([(k,)], "k long"), "k")])
        assert files_holding(index, blocks) == [f"f{i % 3}"]
        if i == 7:
            break
    none = key_blocks(spark.createDataFrame([(12345,)], "k long"), "k")
    assert files_holding(index, none) == [] and merged([]) is None


def test_fact_index_grows_with_the_rows_not_with_files_times_blocks(spark, tmp_path):
    # five files that each hold keys of eighty blocks
    rows = spark.range(400).selectExpr("concat('f', id % 5) file", "id * 40000 k")
    key_rows(rows, "k", "file").sortWithinPartitions("k").write.parquet(str(tmp_path / "rows"))
    index = spark.read.parquet(str(tmp_path / "rows"))
    assert index.count() == 400 and [f.dataType.typeName() for f in index.schema] == ["string", "long", "long"]
    for i in (0, 7, 399):
        keys = spark.createDataFrame([(i * 40000,), (i * 40000 + 1,), (None,)], "k long")
        assert files_with(index, keys, "k", key_blocks(keys, "k")) == [f"f{i % 5}"]
    none = spark.createDataFrame([(12345,)], "k long")
    assert files_with(index, none, "k", key_blocks(none, "k")) == []
    assert files_with(index, none.limit(0), "k", key_blocks(none.limit(0), "k")) == []


def test_stored_fact_index_holds_keys_not_bitmaps(spark):
    assert "bits" not in key_rows(spark.range(3).selectExpr("id k", "'f' file"), "k", "file").columns
    assert key_rows(spark.createDataFrame([(1, "a"), (None, "a")], "k long, file string"), "k", "file").count() == 1


def test_a_run_leaves_nothing_staged_and_files_of_bounded_rows(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(B, "ROWS_A_FILE", 4)
    out = os.path.join(tmp_dir, "wh")
    rows = [_moved(_at(11, i), i // 6) for i in range(1, 25)]
    _run(spark, out, rows[:16], 1)
    _run(spark, out, [_moved(rows[0], -1), *rows[8:]], 2)  # eight unchanged, one moved, eight new
    facts = _facts(spark, out)
    assert len(facts) == 24 and {k for k, v in facts.items() if v[1] == 2} == {1, *range(17, 25)}
    left = [f for _, _, fs in os.walk(os.path.join(out, "staged")) for f in fs]
    assert not left and not [d for d in os.listdir(os.path.join(out, "staged")) if os.listdir(os.path.join(out, "staged", d))]
    # a folded delivery is moved, not the whole batch
    checkpoints = spark.sparkContext.getCheckpointDir()
    was = sum(len(fs) for _, _, fs in os.walk(checkpoints.removeprefix("file:")))
    _run(spark, out, rows[:2], 3)
    assert sum(len(fs) for _, _, fs in os.walk(checkpoints.removeprefix("file:"))) == was
    assert _facts(spark, out)[1] == (rows[0][6].year * 10000 + rows[0][6].month * 100 + rows[0][6].day, 3)
    written = [len([1 for f in fs if f.startswith("part-")]) for d, _, fs in os.walk(os.path.join(out, "fact_deliveries")) if fs]
    assert max(written) >= 4
