"""Registered source/sink queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.session import checkpoint_dir
from convoy.sources import sinks
from convoy.sources.fleet import cached_fleet, read_driver_table

LOAD_TS = "2001-08-01 00:00:00"


def staging_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties staged as VARIANT and read back as a typed field."""
    ev = read_driver_table(spark, sf_dir, "events")
    staged = sinks.stage_raw_json(ev, "props", LOAD_TS)
    return sinks.staged_fields(staged, {"k": "bigint"})


def snapshot_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy all fleet tables to a snapshot folder, then compare counts."""
    fleet = cached_fleet(spark, sf_dir)
    out = f"{checkpoint_dir(spark).rstrip('/')}/convoy-snapshot-{uuid.uuid4().hex}"
    return sinks.reconcile(spark, fleet, sinks.snapshot(fleet, out))


def snapshot_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of the deliveries in which rows were lost, added and changed, against the table."""
    d = cached_fleet(spark, sf_dir).deliveries
    out = f"{checkpoint_dir(spark).rstrip('/')}/convoy-snapshot-{uuid.uuid4().hex}"
    i = F.col("delivery_id")
    wrong = (d.where(i % 1009 != 5).withColumn("package_weight_kg", F.when(i % 997 == 3, F.col("package_weight_kg") + 1)
                                               .otherwise(F.col("package_weight_kg")).cast("decimal(10,2)"))
             .withColumn("delivery_status", F.when(i % 1499 == 1, F.lit(None)).otherwise(F.col("delivery_status"))))
    wrong.unionByName(d.where(i % 2003 == 9).withColumn("delivery_id", -i)).write.parquet(out)
    return sinks.differences(d, spark.read.parquet(out), "delivery_id")
