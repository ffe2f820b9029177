"""Stored daily batches: corrections by key, and reruns in any order.

Everything lies under one folder, and a run writes only into folders of its own:

* ``raw-data``: the extracted rows as they arrived (VARIANT);
* ``processed-data``: per batch, all accepted rows (``deliveries``) and the
  snapshots of vehicles, drivers and routes - what the batch saw, never changed;
* ``fact_deliveries``: one row for each delivery. A delivery that comes again
  unchanged stays where it is; changed, its newest version (by batch number)
  replaces the older one, whatever its day was and is;
* next to each fact file its parts (``*_parts``, ``day_*``): customers, ratings and
  day states that add up over files;
* ``dim_vehicle``, ``dim_driver`` as of each batch, ``daily_totals`` of the days a run touched.

``manifest`` (:mod:`convoy.plans.manifest`) names what is in effect; it is written last. What
a run needs twice it keeps in ``staged`` until it ends.

A batch finds stored versions of its deliveries through key indexes
(:mod:`convoy.operators.key_index`), so it opens only the files that hold them, and rewrites
only those in which a row is replaced. What is in effect follows from the
batches alone, not from the order in which they were loaded or rerun: versions
are folded by batch number, customers, ratings, calendar and totals are sums over the
live files, and a batch that comes before others lets the type-2
dimensions of the later ones be folded again from their snapshots. ``delivery_id``
is the source's primary key.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convoy.functions import columns as C
from convoy.operators.key_index import files_holding, files_with, key_blocks, key_rows, merged
from convoy.operators.lineage import release
from convoy.plans import manifest
from convoy.plans import warehouse as W
from convoy.plans.manifest import Batch, State
from convoy.sources.fleet import Fleet
from convoy.sources.sinks import remove, stage_raw_json

# Rows of a fact file, which one task sorts and writes.
ROWS_A_FILE = 500_000

#: Tables of parts, one row group of each for every live fact file.
PARTS = ("fact_index", "customer_parts", "driver_parts", "day_parts", "day_keys", "day_customers")

# Measures that depend on which other deliveries the window holds.
_OF_WINDOW = ("deliveries_per_hour", "cost_per_delivery")


def _hash(cols: list[str]) -> F.Column:
    every = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    return F.struct(F.xxhash64(F.lit(1), *every).alias("a"), F.xxhash64(F.lit(2), *every).alias("b"))


def _write(df: DataFrame, path: str) -> None:
    df.write.option("compression", "zstd").parquet(path)


def _with_file(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("file"))


class _Folder:
    """Paths and reads below a warehouse folder."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")

    def landed(self, name: str, batch: int, run: str) -> str:
        return f"{self.out}/processed-data/{name}/batch={batch}/run={run}"

    def snapshot(self, name: str, batch: int, run: str) -> DataFrame:
        return self.spark.read.parquet(self.landed(name, batch, run))

    def of_run(self, name: str, run: str) -> str:
        return f"{self.out}/{name}/run={run}"

    def staged(self, df: DataFrame, name: str, run: str) -> DataFrame:
        """``df`` computed once, until the run ends."""
        path = self.of_run(f"staged/{name}", run)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def dims(self, name: str, batch: int, b: Batch) -> DataFrame:
        return self.spark.read.parquet(f"{self.of_run(name, b.dims)}/as_of_batch={batch}")

    def parts(self, name: str, state: State) -> DataFrame | None:
        """Parts of the live files (``None`` without any)."""
        if not state.files:
            return None
        runs = sorted({f.split("/run=")[1].split("/")[0] for f in state.files})
        own = self.spark.read.parquet(*[self.of_run(name, r) for r in runs])
        return own.join(state.live(self.spark), "file", "left_semi")


# Facts --------------------------------------------------------------------
def effective(versions: DataFrame) -> DataFrame:
    """The version in effect of each delivery: the first of the newest run of versions
    with equal content (by batch number), so that an unchanged delivery keeps its row."""
    content = [c for c in versions.columns if c not in (*_OF_WINDOW, "etl_batch_id", "etl_timestamp")]
    in_order = Window.partitionBy("delivery_id").orderBy("etl_batch_id")
    v = versions.withColumn("_c", _hash(content))
    v = v.withColumn("_new", ~F.col("_c").eqNullSafe(F.lag("_c").over(in_order)))
    last = F.max(F.when(F.col("_new"), F.col("etl_batch_id"))).over(Window.partitionBy("delivery_id"))
    return v.withColumn("_last", last).where(F.col("etl_batch_id") == F.col("_last")).drop("_c", "_new", "_last")


def _land(folder: _Folder, facts: DataFrame, rows: int, batch: int, run: str) -> DataFrame:
    path = folder.landed("deliveries", batch, run)
    _write(facts.repartitionByRange(1 + rows // ROWS_A_FILE, "delivery_id").sortWithinPartitions("delivery_id"), path)
    stored = folder.spark.read.schema(facts.schema).parquet(path)
    _write(key_blocks(_with_file(stored), "delivery_id", "file"), folder.landed("deliveries_index", batch, run))
    return stored


def _merge(folder: _Folder, was: State, mine: DataFrame | None, batch: int, run: str) -> tuple[State, set[int]]:
    """Fact files once ``mine`` (``None``: no rows) stands for the batch; the days touched."""
    spark, old = folder.spark, was.batches.get(batch)
    index = [folder.snapshot("deliveries_index", batch, r) for r in ([old.run] if old else []) + ([run] if mine is not None else [])]
    blocks = merged(index)
    if blocks is None:
        return was, set()
    blocks = folder.staged(blocks, "blocks", run)
    held = None
    for b, x in was.batches.items():
        if b != batch:
            own = folder.snapshot("deliveries_index", b, x.run)
            held = own if held is None else held.unionByName(own)
    again = files_holding(held, blocks) if held is not None else []
    former = folder.snapshot("deliveries", batch, old.run) if old else None
    some = former if mine is None else mine
    schema, keys = some.schema, some.select("delivery_id")
    if former is not None and mine is not None:
        keys = keys.unionByName(former.select("delivery_id")).distinct()
    live = folder.parts("fact_index", was)
    hit = files_with(live, keys, "delivery_id", blocks) if live is not None else []

    def read(files: list[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(*files)

    versions = mine
    if again:
        # only deliveries that other batches hold as well have versions to fold: few, as a rule,
        # so that the batch's own rows are not moved for them
        both = read(again).select("delivery_id").join(keys, "delivery_id", "left_semi").distinct()
        both = folder.staged(both, "both", run)
        met = read(again).join(both, "delivery_id", "left_semi")
        if mine is not None:
            met = met.unionByName(mine.join(both, "delivery_id", "left_semi"))
        versions = folder.staged(effective(met), "versions", run)
        if mine is not None:
            versions = versions.unionByName(mine.join(both, "delivery_id", "left_anti"))
    if versions is None:
        versions = some.limit(0)
    new, dropped, days = versions, [], set()
    if hit:
        # rows are told apart by their hashes; of the stored ones nothing else is moved
        row = _hash([f.name for f in schema if f.name != "etl_timestamp"]).alias("_row")
        now = _with_file(read(hit)).select("delivery_id", "date_key", F.xxhash64("file").alias("_file"), row)
        now = folder.staged(now.join(keys, "delivery_id", "left_semi"), "now", run)
        same = ["delivery_id", "_row"]
        gone = folder.staged(now.join(versions.select("delivery_id", row), same, "left_anti"), "gone", run)
        new = folder.staged(versions.withColumn("_row", row).join(now.select(*same), same, "left_anti").drop("_row"), "new", run)
        held_by = gone.select("_file").distinct()
        dropped = sorted(r.file for r in was.live(spark).join(held_by, F.xxhash64("file") == F.col("_file"), "left_semi").collect())
        if dropped:
            days = {r.date_key for df in (gone, new) for r in df.select("date_key").distinct().collect()}
            kept = read(dropped).join(gone.select("delivery_id"), "delivery_id", "left_anti")
            new = new.unionByName(kept.select(*new.columns))
    written = _write_facts(folder, new, run)
    files = tuple(sorted({*was.files, *written} - set(dropped)))
    if not dropped:
        days |= {r.date_key for r in folder.spark.read.parquet(folder.of_run("day_parts", run)).select("date_key").distinct().collect()}
    return replace(was, files=files), days


def _write_facts(folder: _Folder, new: DataFrame, run: str) -> list[str]:
    """Write fact rows in ranges of days, with their parts; the files that hold rows."""
    path, n = folder.of_run("fact_deliveries", run), new.count()
    # whole files of consecutive days (a large day in several): a day's filter
    # skips files and row groups, and small batches make few files
    _write(new.repartitionByRange(1 + n // ROWS_A_FILE, "date_key", "delivery_id").sortWithinPartitions("date_key", "delivery_id"), path)
    stored = _with_file(folder.spark.read.schema(new.schema).parquet(path))
    ratings = stored.groupBy("file", "driver_id", "etl_batch_id").agg(
        F.count("is_on_time").alias("n"), F.count_if("is_on_time").alias("on_time"), F.count(F.lit(1)).alias("rows"))
    index = key_rows(stored, "delivery_id", "file").repartitionByRange(1 + n // ROWS_A_FILE, "delivery_id").sortWithinPartitions("delivery_id")
    parts = {"fact_index": index, "customer_parts": W.customer_parts(stored, "file"),
             "driver_parts": ratings, "day_parts": W.day_parts(stored, "file"), "day_keys": W.day_keys(stored, "file"),
             "day_customers": W.day_customers(stored, "file")}
    _write_all({folder.of_run(name, run): p.coalesce(1 + n // ROWS_A_FILE) for name, p in parts.items()})
    return [r.file for r in folder.spark.read.parquet(folder.of_run("day_parts", run)).select("file").distinct().collect()]


def _write_all(tables: dict[str, DataFrame]) -> None:
    """Write independent tables side by side; the first failure is raised."""
    with ThreadPoolExecutor(max(1, len(tables))) as pool:
        list(pool.map(lambda t: _write(t[1], t[0]), tables.items()))


# Dimensions ---------------------------------------------------------------
def _rates(folder: _Folder, state: State, batch: int) -> DataFrame | None:
    """On-time share of each driver over the facts of batches up to ``batch``."""
    parts = folder.parts("driver_parts", state)
    if parts is None:
        return None
    sums = parts.where(F.col("etl_batch_id") <= batch).groupBy("driver_id").agg(F.sum("n").alias("n"), F.sum("on_time").alias("k"))
    return sums.select("driver_id", F.try_divide(F.col("k").cast("double"), F.col("n").cast("double")).alias("on_time_rate"))


def _fold_versions(folder: _Folder, state: State, batch: int, run: str) -> State:
    """Fold the type-2 dimensions again from ``batch`` on; earlier ones stay."""
    earlier = [b for b in state.batches if b < batch]
    dv = dd = None
    if earlier:
        last = max(earlier)
        dv, dd = (folder.dims(n, last, state.batches[last]) for n in ("dim_vehicle", "dim_driver"))
    batches = dict(state.batches)
    for b in sorted(x for x in batches if x >= batch):
        drivers = W.with_rating(folder.snapshot("drivers", b, batches[b].run), _rates(folder, state, b))
        dv, dd = W.next_versions(dv, dd, folder.snapshot("vehicles", b, batches[b].run), drivers,
                                 F.lit(batches[b].day).cast("date"))
        batches[b] = replace(batches[b], dims=run)
        _write_all({f"{folder.of_run(n, run)}/as_of_batch={b}": d for n, d in (("dim_vehicle", dv), ("dim_driver", dd))})
        dv, dd = (folder.dims(n, b, batches[b]) for n in ("dim_vehicle", "dim_driver"))
    return replace(state, batches=batches)


def _totals(folder: _Folder, state: State, days: set[int], as_of, batch: int, run: str) -> State:
    """Totals of ``days`` (one row each, also without facts) out of the live files' day states."""
    asked = folder.spark.createDataFrame([(d,) for d in sorted(days)], "date_key int")
    tables = [folder.parts(n, state) for n in ("day_parts", "day_keys", "day_customers")]
    if tables[0] is None:
        none = folder.spark.createDataFrame([], W.FACT_STUB)
        tables = [f(none) for f in (W.day_parts, W.day_keys, W.day_customers)]
    few = F.broadcast(asked)  # the days of one batch
    totals = asked.join(W.totals_of(*[t.join(few, "date_key", "left_semi") for t in tables]), "date_key", "left")
    counts = [c for c in totals.columns if c.endswith("_distinct") or c in (
        "total_deliveries", "total_vehicles", "total_drivers", "total_routes", "total_customers")]
    for c in counts:
        totals = totals.withColumn(c, F.coalesce(c, F.lit(0).cast("bigint")))
    head = [W.batch_date(as_of).alias("date_update"), F.lit(str(batch)).alias("etl_batch_id")]
    totals.select(*head, "*").coalesce(1).write.parquet(folder.of_run("daily_totals", run))
    return replace(state, totals={**state.totals, **dict.fromkeys(days, run)})


# The daily run ------------------------------------------------------------
def run_daily(spark: SparkSession, fleet: Fleet, out: str, as_of, batch_id: int,
              start=None, end=None, last_day: bool = True) -> dict:
    """Extract, transform, load dimensions and facts, roll up the touched days and ``as_of``'s.

    A rerun replaces its own batch; batches may come in any order. Loads are
    skipped when the extract is empty; totals still run (one row for the day, as
    the source). A run that breaks off leaves nothing that :func:`stored` shows.
    """
    t0 = time.time()
    folder, run = _Folder(spark, out), f"run{uuid.uuid4().hex}"
    was = manifest.current(spark, folder.out)
    m = folder.staged(W.measured(W.extract(fleet, start, end, last_day)), "measured", run)
    release(spark)
    counts = m.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("reject_reason").isNull()).alias("ok")).first()
    mine, landing = None, {}
    # steps that don't wait for each other run side by side
    with ThreadPoolExecutor(2) as pool:
        if counts["n"]:
            raw = stage_raw_json(m.select(F.to_json(F.struct(*W.EXTRACT_COLUMNS)).alias("raw")), "raw")
            landing = {f"{folder.out}/raw-data/staging_daily_load/batch={batch_id}/run={run}": raw,
                       folder.landed("vehicles", batch_id, run): W.vehicle_snapshot(fleet, as_of),
                       folder.landed("drivers", batch_id, run): W.driver_snapshot(fleet, as_of),
                       folder.landed("routes", batch_id, run): W.dim_route(fleet)}
        landed = pool.submit(_write_all, landing)
        if counts["n"]:
            accepted, _ = W.split_measured(m)
            mine = _land(folder, W.with_batch(W.fact_rows(accepted), batch_id), counts["ok"], batch_id, run)
        state, days = _merge(folder, was, mine, batch_id, run)
        landed.result()
        remove(spark, folder.of_run("staged/measured", run))
        release(spark)
        day = str(spark.range(1).select(W.batch_date(as_of)).first()[0])
        batches = {b: x for b, x in was.batches.items() if b != batch_id}
        if mine is not None:
            batches[batch_id] = Batch(run, day, run)
        state = replace(state, batches=batches)
        summed = pool.submit(_totals, folder, state, days | {int(day.replace("-", ""))}, as_of, batch_id, run)
        if state.files != was.files or batches != was.batches:
            state = _fold_versions(folder, state, batch_id, run)
        loaded, unknown = _loaded(folder, state, mine.schema, batch_id, run) if mine is not None else (0, 0)
        state = replace(state, totals=summed.result().totals)
    manifest.publish(spark, folder.out, state)
    for name in ("blocks", "both", "versions", "now", "gone", "new"):
        remove(spark, folder.of_run(f"staged/{name}", run))
    metrics = {"batch_id": batch_id, "records_extracted": int(counts["n"]), "records_transformed": int(counts["ok"]),
               "records_loaded": int(loaded), "errors": int(unknown), "duration_s": round(time.time() - t0, 3)}
    spark.createDataFrame([dict(metrics, run=run)]).coalesce(1).write.mode("overwrite").json(f"{folder.out}/etl_metrics/batch={batch_id}")
    return metrics


def _loaded(folder: _Folder, state: State, schema, batch: int, run: str) -> tuple[int, int]:
    """Rows in effect of a batch, and how many of those that ``run`` wrote meet no member
    of a dimension."""
    parts, unknown = folder.parts("driver_parts", state), 0
    loaded = parts.where(F.col("etl_batch_id") == batch).agg(F.sum("rows")).first()[0] if parts is not None else 0
    written = [f for f in state.files if f"/run={run}/" in f]
    if written:
        keyed = _keyed(folder, state, folder.spark.read.schema(schema).parquet(*written).where(F.col("etl_batch_id") == batch))
        unknown = keyed.where((F.col("vehicle_key") == -1) | (F.col("driver_key") == -1)
                              | (F.col("route_key") == -1) | (F.col("customer_key") == -1)).count()
    return loaded or 0, unknown


def _keyed(folder: _Folder, state: State, facts: DataFrame) -> DataFrame:
    b = state.newest
    dv, dd = (folder.dims(n, b, state.batches[b]) for n in ("dim_vehicle", "dim_driver"))
    return W.keyed_facts(facts, dv, dd, folder.snapshot("routes", b, state.batches[b].run))


def stored(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables in effect under ``out``; facts meet their dimension versions as they are
    read, the calendar spans the facts, and customers are added up over the live files.
    Nothing before the first batch with data."""
    folder = _Folder(spark, out)
    state = manifest.current(spark, folder.out)
    if state.newest is None:
        return {}
    newest = state.batches[state.newest]
    schema = folder.snapshot("deliveries", state.newest, newest.run).schema
    facts = spark.read.schema(schema).parquet(*state.files) if state.files else spark.createDataFrame([], schema)
    parts = folder.parts("customer_parts", state)
    days = folder.parts("day_parts", state)
    picked = spark.createDataFrame(list(state.totals.items()), "date_key int, run string")
    totals = spark.read.option("basePath", f"{folder.out}/daily_totals").parquet(
        *[folder.of_run("daily_totals", r) for r in sorted(set(state.totals.values()))])
    return {
        "fact_deliveries": _keyed(folder, state, facts),
        "dim_vehicle": folder.dims("dim_vehicle", state.newest, newest),
        "dim_driver": folder.dims("dim_driver", state.newest, newest),
        "dim_customer": W.customers_of(W.customer_parts(facts) if parts is None else parts),
        "dim_route": folder.snapshot("routes", state.newest, newest.run),
        "dim_date": W.dim_date_of_keys(facts if days is None else days),
        "dim_time": W.dim_time(spark),
        "daily_totals": totals.join(F.broadcast(picked), ["date_key", "run"], "left_semi").drop("run"),  # a row a day
    }


def stored_views(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Both role views over the stored tables."""
    t = stored(spark, out)
    return {"v_sales": W.v_sales(t["fact_deliveries"], t["dim_date"], t["dim_customer"]),
            "v_operations": W.v_operations(t["fact_deliveries"], *[t[n] for n in (
                "dim_date", "dim_time", "dim_vehicle", "dim_driver", "dim_route", "dim_customer")])}
