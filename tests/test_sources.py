import datetime as dt
import json
import os

import pytest

from conftest import SF_SMALL
from convoy.plans import quality as Q
from convoy.plans import warehouse as W
from convoy.sources import sinks
from convoy.sources.fleet import cached_fleet, fleet_from_tpch


def test_append_table_checks_schema(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    sinks.append_table(a, path)
    sinks.append_table(spark.createDataFrame([("y", 2)], "v string, id int"), path)
    assert sorted(spark.read.parquet(path).collect()) == [(1, "x"), (2, "y")]
    with pytest.raises(sinks.SchemaMismatch):
        sinks.append_table(spark.createDataFrame([(3,)], "other int"), path)


def test_variant_staging_keeps_bad_json_as_null(spark):
    df = spark.createDataFrame([('{"k": 5, "s": "a"}',), ("not json",)], "props string")
    staged = sinks.stage_raw_json(df, "props", "2001-08-01 00:00:00")
    assert dict(staged.dtypes)["raw_data"] == "variant"
    got = sorted(sinks.staged_fields(staged, {"k": "bigint", "s": "string"})
                 .select("k", "s").collect(), key=str)
    assert [tuple(r) for r in got] == [(5, "a"), (None, None)]


def test_summary_json_content(spark):
    fleet = cached_fleet(spark, SF_SMALL)
    (row,) = Q.summary_json(fleet, "2001-08-01 00:00:00").collect()
    s = json.loads(row.summary)
    counts = {r.table_name: r.row_count for r in Q.table_counts(fleet).collect()}
    assert s["table_counts"] == counts
    assert s["total_records"] == sum(counts.values())
    assert s["generation_date"] == "2001-08-01T00:00:00"
    stats = Q.trip_delivery_stats(fleet).first()
    assert (s["min_deliveries"], s["max_deliveries"]) == (stats.min_deliveries, stats.max_deliveries)
    assert s["validations_passed"] == all(r.ok for r in Q.validation_checks(fleet).collect())


def test_cached_fleet_equals_derived(spark):
    cached = cached_fleet(spark, SF_SMALL)
    derived = fleet_from_tpch(spark, SF_SMALL)
    for (name, a), (_, b) in zip(cached.items(), derived.items()):
        assert [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema], name
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_inventory(spark):
    inv = {r.table_name: r.column_count for r in Q.table_inventory(spark, cached_fleet(spark, SF_SMALL)).collect()}
    assert inv == {"deliveries": 10, "drivers": 9, "maintenance": 8, "routes": 7, "trips": 9, "vehicles": 7}
    fleet = cached_fleet(spark, SF_SMALL)
    assert [r.table_name for r in Q.table_inventory(spark, fleet, like="d%").collect()] == \
        ["deliveries", "drivers"]


def test_dim_time_and_dim_date(spark):
    t = W.dim_time(spark)
    assert t.count() == 1440
    row = t.where("time_key = 1430").first()
    assert (row.hour_24, row.hour_12, row.am_pm, row.time_of_day, row.shift) == \
        ("14:30", "02:30 PM", "PM", "Tarde", "Turno 2")
    assert t.where("time_key = 0").first().hour_12 == "12:00 AM"
    hol = spark.createDataFrame([(dt.date(2001, 7, 20), "Independencia")], "holiday_date date, holiday_name string")
    d = W.dim_date(spark, "2001-07-19", "2001-07-22", hol)
    rows = {r.date_key: r for r in d.collect()}
    assert sorted(rows) == [20010719, 20010720, 20010721, 20010722]
    assert rows[20010720].is_holiday and rows[20010720].holiday_name == "Independencia"
    assert rows[20010721].is_weekend and rows[20010721].day_of_week == 6
    assert not rows[20010719].is_holiday


def test_append_rejects_another_type(spark, tmp_dir):
    import pytest

    from convoy.sources.sinks import SchemaMismatch, append_table
    path = f"{tmp_dir}/typed"
    append_table(spark.createDataFrame([(1, "a")], "n int, s string"), path)
    append_table(spark.createDataFrame([("b", 2)], "s string, n int"), path)
    with pytest.raises(SchemaMismatch):
        append_table(spark.createDataFrame([("3", "c")], "n string, s string"), path)
    assert spark.read.parquet(path).count() == 2


def test_differences_name_every_changed_cell(spark):
    from convoy.sources.sinks import differences
    a = spark.createDataFrame([(i, f"v{i}", None if i % 5 else i) for i in range(-50, 400)], "id long, v string, n int")
    assert differences(a, a.repartition(3), "id").count() == 0
    b = [(i, "x" if i == 7 else None if i == 300 else f"v{i}", 0 if i in (7, 8) else None if i % 5 else i) for i in range(-50, 400) if i not in (9, 399)]
    b = spark.createDataFrame([*b, (1000, "new", 1)], "id long, v string, n int")
    want = {7: "changed: v, n", 8: "changed: n", 300: "changed: v", 9: "missing", 399: "missing", 1000: "extra"}
    for leaves in (1, 16, 4096):
        assert dict(tuple(r) for r in differences(a, b, "id", leaves=leaves, fanout=4).collect()) == want
    none = a.limit(0)
    assert differences(none, none, "id").count() == 0
    assert {r.difference for r in differences(a, none, "id").collect()} == {"missing"}


def test_fleet_tables_are_written_when_asked_for(spark, tmp_path):
    import os
    import shutil
    from convoy.session import checkpoint_dir

    sf = str(tmp_path / "sf")
    shutil.copytree(SF_SMALL, sf)
    stored = lambda: {p for p in os.listdir(checkpoint_dir(spark).removeprefix("file:")) if p.startswith("convoy-fleet-")}
    before = stored()
    fleet = cached_fleet(spark, sf)
    assert fleet.vehicles.count() == spark.read.parquet(f"{sf}/supplier.parquet").count()
    (new,) = stored() - before
    assert os.listdir(f"{checkpoint_dir(spark).removeprefix('file:')}/{new}") == ["vehicles"]
    assert [name for name, _ in fleet.items()] == ["vehicles", "drivers", "routes", "trips", "deliveries", "maintenance"]


def test_sorts_of_fleet_tables_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    from convoy.sources import fleet as FL

    derived = fleet_from_tpch(spark, SF_SMALL)
    monkeypatch.setattr(FL, "SORT_ROWS", 100)
    wide = fleet_from_tpch(spark, SF_SMALL)
    for name in ("trips", "deliveries"):
        FL.write_table(wide, name, str(tmp_path / name))
        got = FL.load_table(spark, str(tmp_path), name)
        want = getattr(derived, name)
        assert len(got.inputFiles()) > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
