"""Distributed prefix sums: row numbers and running totals without a global window.

Rows are range-partitioned by the order, numbered inside their partition by
position, and shifted by the counts (and sums) of all partitions before. Only
one row of counts a partition reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convoy.operators.lineage import materialize


def _placed(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows sorted over range partitions, with partition and position."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumn("_prefix_id", F.monotonically_increasing_id()))
    # the id holds the partition above 33 bits of position
    return placed.withColumn("_prefix_pid", F.shiftright("_prefix_id", 33).cast("int")).withColumn(
        "_prefix_at", F.col("_prefix_id").bitwiseAND((1 << 33) - 1)).drop("_prefix_id")


def row_numbers(df: DataFrame, order: list[Column], out: str = "row_number") -> DataFrame:
    """``df`` with ``out``, 1 for the first row in ``order``. An order that does not
    tell rows apart numbers them in any way."""
    return running_totals(df, order, {}, out)


def running_totals(df: DataFrame, order: list[Column], totals: dict[str, str], number: str | None = None) -> DataFrame:
    """``df`` with, for each ``value: name`` of ``totals``, the sum of ``value`` (long,
    without NULLs) over all rows *before* the row; ``number`` names a row number.
    No rows give no rows."""
    spark, placed = df.sparkSession, _placed(df, order)
    counts = placed.groupBy("_prefix_pid").agg(F.count("*").alias("_prefix_n"), *(F.sum(v).alias(f"_prefix_s{i}") for i, v in enumerate(totals)))
    ahead, shifts = [0] * (1 + len(totals)), []
    for r in sorted(counts.collect()):  # one row a partition
        shifts.append((r[0], *ahead))
        ahead = [a + b for a, b in zip(ahead, r[1:])]
    ddl = ", ".join(["_prefix_pid int", "_prefix_n long", *(f"_prefix_s{i} long" for i in range(len(totals)))])
    out = placed.join(F.broadcast(spark.createDataFrame(shifts, ddl)), "_prefix_pid")
    if number:
        out = out.withColumn(number, F.col("_prefix_at") + F.col("_prefix_n") + 1)
    if totals:
        before = Window.partitionBy("_prefix_pid").orderBy("_prefix_at").rowsBetween(Window.unboundedPreceding, -1)
        for i, (v, name) in enumerate(totals.items()):
            out = out.withColumn(name, F.coalesce(F.sum(v).over(before), F.lit(0).cast("long")) + F.col(f"_prefix_s{i}"))
    return out.select(*df.columns, *([number] if number else []), *totals.values())
