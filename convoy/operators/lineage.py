"""Cutting lineage of reused intermediates.

A DataFrame that feeds several branches of one plan is otherwise recomputed
once per branch. :func:`materialize` writes it with a reliable checkpoint to
the shared folder named by ``spark.checkpoint.dir`` (set by the cluster; a
scratch folder is registered only when it is unset, as in tests), so a lost
executor does not force recomputation from the sources.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from convoy.session import checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps now: it does so when the
    driver's garbage is collected, which a long run may not see before the disk is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
