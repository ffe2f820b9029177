"""Sharding by a two-pass external shuffle.

Pass one scatters whole records by seeded hashes into buckets that fit in
memory; pass two shuffles each bucket by Fisher and Yates's method and writes it. The
buckets in a row are one random order of all records, which is cut into shards of
equal numbers of rows (law ``rows``: at most one apart).

The order follows from the seed and the records alone: a bucket is put in
the order of the hashes before it is shuffled, so reruns, other partitionings and
repeated tasks write the same shards. Hashes take in every column. Records
that are wholly equal are told apart by a copy number, so that no bucket receives
them all; of their copies only one is moved through the shuffle that finds them.

NULLs in any column are kept, a NULL text is no bytes long. Records are stored in
one struct column, so their names cannot clash with ``shard`` and ``slot``. No
records give an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from convoy.llm.common import byte_slices, cut, lean, parts, scratch
from convoy.operators.expand import expand_range
from convoy.operators.prefix import running_totals

#: Text bytes of a bucket.
BUCKET = 16_000_000


def fisher_yates(n: int, seed: list[int]) -> list[int]:
    """A permutation of ``range(n)``: from the last place down, each is exchanged with
    one drawn from the places up to it."""
    order = list(range(n))
    draws = np.random.Generator(np.random.PCG64(seed)).integers(0, np.arange(n, 1, -1)).tolist() if n > 1 else []
    for i, j in zip(range(n - 1, 0, -1), draws):
        order[i], order[j] = order[j], order[i]
    return order


def _hashes(cols: list[str], seed: int):
    """Two 64-bit hashes of all columns; a NULL (which the hash skips) by a mark."""
    every = [x for c in cols for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.xxhash64(F.lit(seed), F.lit(i), *every).alias(f"_h{i}") for i in range(2)]


def _copy_key():
    """Place of a copy: its record's own hash for the first, one of its own after."""
    return F.when(F.col("_copy") == 0, F.col("_h0")).otherwise(F.xxhash64("_h0", "_h1", "_copy"))


def _shuffled(text: str, seed: int, rows: int, shards: int):
    """Buckets one after the other: shuffled, with shard and slot."""
    bounds = [-(-rows * s // shards) for s in range(shards + 1)]  # first place of each shard

    def emit(bucket, held):
        t = pa.Table.from_batches(held)
        place = t["_start"][0].as_py() + np.arange(len(t))
        shard = np.searchsorted(bounds, place, side="right") - 1
        order = pa.array(fisher_yates(len(t), [seed, bucket]))
        record = pa.concat_arrays(t["record"].chunks).take(order)
        out = pa.RecordBatch.from_arrays([record, pa.array(shard.astype(np.int32)), pa.array(place - np.array(bounds)[shard])],
                                         names=["record", "shard", "slot"])
        for s in byte_slices(record.field(text)):
            yield out.slice(s.start, s.stop - s.start)

    def run(batches):
        bucket, held = None, []
        for b in batches:
            at = b["_bucket"].to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)] if len(at) else []
            for s, e in zip(cuts[:-1], cuts[1:]):
                if held and at[s] != bucket:
                    yield from emit(bucket, held)
                    held = []
                bucket = int(at[s])
                held.append(b.slice(s, e - s))
        if held:
            yield from emit(bucket, held)

    return run


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 12, text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """Write all records of ``docs`` to ``path`` (a folder ``shard=<i>`` for each shard, rows in the
    order of ``slot``) and read them back: ``record``, ``slot`` (from 0 in each shard), ``shard``."""
    spark, width = docs.sparkSession, parts(docs)
    size = (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 1).cast("long").alias("_size")
    known = cut(docs.select(*_hashes(docs.columns, seed), size).groupBy("_h0", "_h1").agg(
        F.count("*").alias("_n"), F.max("_size").alias("_size")))
    rows, total, most = known.agg(F.sum("_n"), F.sum(F.col("_n") * F.col("_size")), F.max("_n")).first()
    buckets = max(1, -(-(total or 0) // bucket))

    def copies(once: DataFrame) -> DataFrame:
        """All copies of each record, numbered from 0."""
        first = once.withColumn("_copy", F.lit(0).cast("long"))
        if (most or 1) == 1:
            return first
        again = expand_range(once.withColumn("_more", F.col("_n") - 1), "_more", "_copy", ["_h0", "_h1"])
        return first.unionByName(again.drop("_more").withColumn("_copy", F.col("_copy") + 1))

    def dealt(once: DataFrame) -> DataFrame:
        keyed = copies(once).withColumn("_key", _copy_key())
        return keyed.withColumn("_bucket", F.pmod("_key", F.lit(buckets).cast("long")))

    counts = dealt(known).groupBy("_bucket").agg(F.count("*").alias("_rows"))
    starts = running_totals(counts, [F.col("_bucket")], {"_rows": "_start"}).drop("_rows")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("record"), *_hashes(docs.columns, seed))
    if (most or 1) > 1:
        whole = whole.dropDuplicates(["_h0", "_h1"]).join(known.select("_h0", "_h1", "_n"), ["_h0", "_h1"])
    scattered = dealt(whole).repartition(width, "_bucket").join(starts, "_bucket")
    ordered = scattered.sortWithinPartitions("_bucket", "_key", "_h1", "_copy").select("record", "_bucket", "_start")
    record = StructField("record", StructType(docs.schema.fields))
    shard, slot = StructField("shard", IntegerType()), StructField("slot", LongType())
    out = ordered.mapInArrow(lean(_shuffled(text, seed, rows or 0, shards)), StructType([record, shard, slot]))
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(StructType([record, slot, shard])).parquet(path)


def shuffle_to_shards(docs: DataFrame, shards: int = 16, seed: int = 12) -> DataFrame:
    """:func:`write_shards` into a new folder of the shared scratch folder."""
    return write_shards(docs, scratch(docs.sparkSession, "shards"), shards, seed)
