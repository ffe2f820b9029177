"""Sources and sinks around the plans.

* :func:`append_table` - batch append to a parquet table, partitioned, with a
  schema check against the existing table (create-if-missing);
* :func:`write_summary_json` - one-row JSON summary file;
* :func:`stage_raw_json` / :func:`staged_fields` - raw JSON kept as a
  ``VARIANT`` column with its load timestamp, queried with ``variant_get``;
* :func:`latest_per_vehicle` - keyed last-write-wins view of a ping table;
* :func:`snapshot` / :func:`reconcile` - copy every fleet table to a snapshot
  folder and compare row counts source vs copy;
* :func:`read_jdbc` - read a table from a relational source in parallel
  ranges of a numeric key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convoy.operators.lineage import materialize
from convoy.operators.merge import latest_per_key
from convoy.sources.fleet import Fleet


class SchemaMismatch(ValueError):
    pass


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 expected: T.StructType | None = None) -> None:
    """Append ``df`` to the parquet table at ``path``. The first write creates
    it; later writes must carry the same column names and types."""
    spark = df.sparkSession
    if expected is not None:
        got = [(f.name, f.dataType) for f in df.schema.fields]
        want = [(f.name, f.dataType) for f in expected.fields]
        if got != want:
            raise SchemaMismatch(f"columns {got} differ from declared {want}")
    if path_exists(spark, path):
        existing = spark.read.parquet(path).schema
        names = [f.name for f in existing.fields]
        if sorted(names) != sorted(df.columns):
            raise SchemaMismatch(f"{path}: table has {names}, batch has {df.columns}")
        # partition columns come back with the type their folder names suggest
        kinds = {f.name: f.dataType for f in df.schema.fields}
        other = [(f.name, f.dataType, kinds[f.name]) for f in existing.fields
                 if f.dataType != kinds[f.name] and f.name not in (partition_by or [])]
        if other:
            raise SchemaMismatch(f"{path}: types differ (column, table, batch): {other}")
        df = df.select(*names)
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, asked of its own file system; any other failure is raised."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, asked of its own file system; none if it is absent."""
    if not path_exists(spark, path):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(e.getPath().getName() for e in fs.listStatus(p))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own making from its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_summary_json(summary: DataFrame, path: str) -> None:
    """Write a one-row summary (e.g. :func:`convoy.plans.quality.summary_json`)."""
    summary.coalesce(1).write.mode("overwrite").text(path)


def stage_raw_json(df: DataFrame, json_col: str, load_ts=None) -> DataFrame:
    """Staging rows ``(raw_data VARIANT, load_timestamp)``; malformed text
    becomes NULL instead of failing the load."""
    ts = F.localtimestamp() if load_ts is None else F.lit(load_ts).cast("timestamp_ntz")
    return df.select(F.try_parse_json(F.col(json_col)).alias("raw_data"), ts.alias("load_timestamp"))


def staged_fields(staged: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Typed columns out of the staged VARIANT: ``{name: 'type'}`` read at
    ``$.name``."""
    return staged.select(
        *[F.try_variant_get("raw_data", f"$.{k}", t).alias(k) for k, t in fields.items()],
        "load_timestamp")


def latest_per_vehicle(pings: DataFrame) -> DataFrame:
    """Newest ping per vehicle (ties on ``ts`` broken by the higher event id)."""
    keyed = pings.withColumn("_order", F.struct("ts", "event_id"))
    return latest_per_key(keyed, ["vehicle_id"], "_order").drop("_order")


def snapshot(fleet: Fleet, out: str) -> dict[str, str]:
    """Copy every fleet table under ``out``; returns table -> path."""
    paths = {}
    for name, df in fleet.items():
        p = f"{out.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(p)
        paths[name] = p
    return paths


def reconcile(spark: SparkSession, fleet: Fleet, paths: dict[str, str]) -> DataFrame:
    """Per table: rows in the source, rows in the copy, equal or not."""
    parts = []
    for name, df in fleet.items():
        copied = spark.read.parquet(paths[name]).agg(F.count(F.lit(1))).scalar()
        parts.append(df.agg(F.count(F.lit(1)).alias("source_rows"))
                     .select(F.lit(name).alias("table_name"), "source_rows",
                             copied.alias("snapshot_rows")))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("ok", F.col("source_rows") == F.col("snapshot_rows"))


def differences(source: DataFrame, copy: DataFrame, key: str, leaves: int = 4096, fanout: int = 64) -> DataFrame:
    """``key, difference`` of every row in which ``copy`` differs from ``source``: ``missing``,
    ``extra`` or ``changed: <columns>``. ``key`` is a long that identifies a row.

    A tree of order-free sums of row hashes is compared from the root down: ranges of
    the key are leaves, ``fanout`` of them a node. Equal tables are settled by their
    roots, and only rows of leaves that differ are ever brought together.
    """
    cols = [c for c in source.columns if c != key]
    low, high = source.select(key).union(copy.select(key)).agg(F.min(key), F.max(key)).first()
    width = 1 if low is None else max(1, -(-(high - low + 1) // leaves))

    def leaf(df: DataFrame) -> DataFrame:
        every = [x for c in [key, *cols] for x in (F.col(c).isNull(), F.col(c))]
        return df.withColumn("_leaf", F.floor((F.col(key) - F.lit(low)) / F.lit(width)).cast("bigint")).withColumn(
            "_hash", F.xxhash64(*every).cast("decimal(38,0)"))

    def sums(df: DataFrame, side: str) -> DataFrame:
        return leaf(df).groupBy("_leaf").agg(F.sum("_hash").alias(f"{side}_sum"), F.count(F.lit(1)).alias(f"{side}_n"))

    tree = materialize(sums(source, "s").join(sums(copy.select(source.columns), "c"), "_leaf", "full_outer"))  # at most ``leaves`` rows
    node = F.floor(F.col("_leaf") / F.lit(fanout))

    def unequal(level: DataFrame) -> DataFrame:
        agg = level.groupBy("_at").agg(*[F.sum(f"{x}_{y}").alias(f"{x}_{y}") for x in "sc" for y in ("sum", "n")])
        return agg.where(~(F.col("s_sum").eqNullSafe(F.col("c_sum")) & F.col("s_n").eqNullSafe(F.col("c_n")))).select("_at")

    level = tree.withColumn("_at", F.lit(0).cast("bigint"))
    if unequal(level).isEmpty():
        level = level.limit(0)
    level = level.withColumn("_at", node)
    level = level.join(F.broadcast(unequal(level)), "_at", "left_semi").withColumn("_at", F.col("_leaf"))
    found = F.broadcast(materialize(unequal(level).withColumnRenamed("_at", "_leaf")))  # at most ``leaves`` rows
    a = leaf(source).join(found, "_leaf", "left_semi").select(F.col(key).alias("_a"), F.struct(*cols).alias("_x"))
    b = leaf(copy.select(source.columns)).join(found, "_leaf", "left_semi").select(F.col(key).alias("_b"), F.struct(*cols).alias("_y"))
    both = a.join(b, F.col("_a") == F.col("_b"), "full_outer")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"_x.{c}").eqNullSafe(F.col(f"_y.{c}")), F.lit(c)) for c in cols]))
    what = (F.when(F.col("_b").isNull(), F.lit("missing")).when(F.col("_a").isNull(), F.lit("extra"))
            .when(F.size(changed) > 0, F.concat(F.lit("changed: "), F.array_join(changed, ", "))))
    return both.select(F.coalesce("_a", "_b").alias(key), what.alias("difference")).where("difference is not null")


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int,
              partitions: int, properties: dict | None = None) -> DataFrame:
    """Parallel read of a relational table split on a numeric key range.
    Connection options come from the caller, never from code."""
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})
