"""Keyed tables fed by micro-batches, compacted in place of the reader.

A micro-batch is put into a folder of its own (a retried one replaces it), dealt to
buckets of keys. A compaction folds the micro-batches gathered so far into base
files, one row a key, of the buckets they touch; other buckets keep their files.
``manifest/version=<n>`` names the base of each bucket and the last micro-batch in it;
it is one write that counts once its ``_SUCCESS`` marker is there, so a reader sees the
state before or after a compaction, never one in between, and keeps the files it has
opened until :meth:`KeyedTable.retire` drops versions older than the kept ones.

The newest write of a key wins by ``order``, which the rows carry: with the event
time first a late event cannot set a key back, with ``batch_id`` first the last
write wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.operators.merge import latest_per_key
from convoy.sources.sinks import list_names, path_exists, remove


class KeyedTable:
    """``keys`` identify a row, ``order`` columns (``batch_id`` among them if wanted) say
    which write is the newer. ``bucket`` is an SQL expression over the keys (default: a
    hash over ``buckets``); blocks of serial ids keep near ids together."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str], buckets: int = 16,
                 bucket: str | None = None):
        self.spark, self.path, self.keys, self.order = spark, path.rstrip("/"), keys, order
        self.bucket = F.expr(bucket or f"pmod(xxhash64({', '.join(keys)}), {buckets})").cast("bigint")

    # writes
    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Write a micro-batch; the same id again replaces it."""
        dealt = rows.withColumn("_bucket", self.bucket).repartition("_bucket")
        dealt.write.partitionBy("_bucket").mode("overwrite").parquet(f"{self.path}/delta/batch_id={batch_id}")

    def compact(self) -> int:
        """Fold all micro-batches that are complete now into the base; the version published."""
        version, upto, bases = self._newest()
        batches = [b for b in self._batches() if b > upto]
        if not batches:
            return version
        touched = sorted({b for i in batches for b in self._buckets(i)})
        folded = self._rows(batches, {b: v for b, v in bases.items() if b in touched}, None)
        new = max(self._versions(), default=0) + 1
        newest = latest_per_key(self._ordered(folded), self.keys, "_order").drop("_order")
        newest.withColumn("_bucket", self.bucket).repartition("_bucket").sortWithinPartitions("_bucket", *self.keys).write.partitionBy(
            "_bucket").mode("overwrite").parquet(f"{self.path}/base/version={new}")
        bases = {**bases, **dict.fromkeys(touched, new)}
        rows = [(b, v, batches[-1]) for b, v in bases.items()]
        self.spark.createDataFrame(rows, "bucket long, version int, upto long").coalesce(1).write.mode("errorifexists").json(
            f"{self.path}/manifest/version={new:08d}")
        return new

    def retire(self, keep: int = 2) -> None:
        """Drop micro-batches and bases that none of the last ``keep`` versions reads (the
        state before the first compaction counts as a version)."""
        kept = self._versions()[-keep:]
        if len(kept) < keep:
            return
        states = [self._state(v) for v in kept]
        bases = {v for _, _, b in states for v in b.values()}
        for name in list_names(self.spark, f"{self.path}/delta"):
            if int(name.split("=")[1]) <= min(upto for _, upto, _ in states):
                remove(self.spark, f"{self.path}/delta/{name}")
        for name in list_names(self.spark, f"{self.path}/base"):
            if int(name.split("=")[1]) not in bases:
                remove(self.spark, f"{self.path}/base/{name}")

    # reads
    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The newest row of each key as of now (``buckets``: of these alone, nothing else is
        listed or opened); ``None`` before the first write."""
        _, upto, bases = self._newest()
        batches = [b for b in self._batches() if b > upto]
        rows = self._rows(batches, bases, buckets)
        return None if rows is None else latest_per_key(self._ordered(rows), self.keys, "_order").drop("_order")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """Buckets that hold the keys of ``rows`` (NULL keys are in none)."""
        return sorted(r[0] for r in rows.select(self.bucket).distinct().collect() if r[0] is not None)

    def _ordered(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_order", F.struct(*self.order))

    def _rows(self, batches: list[int], bases: dict[int, int], buckets: list[int] | None) -> DataFrame | None:
        """All rows of the named micro-batches and bases."""
        want = None if buckets is None else set(buckets)
        paths = [f"{self.path}/base/version={v}/_bucket={b}" for b, v in bases.items() if want is None or b in want]
        parts = [self.spark.read.parquet(*paths)] if paths else []
        for i in batches:
            held = [b for b in self._buckets(i) if want is None or b in want]
            if held:
                d = self.spark.read.parquet(*[f"{self.path}/delta/batch_id={i}/_bucket={b}" for b in held])
                parts.append(d.withColumn("batch_id", F.lit(i).cast("bigint")))
        out = None
        for p in parts:
            out = p if out is None else out.unionByName(p)
        return out

    def _batches(self) -> list[int]:
        names = list_names(self.spark, f"{self.path}/delta")
        return sorted(int(n.split("=")[1]) for n in names if path_exists(self.spark, f"{self.path}/delta/{n}/_SUCCESS"))

    def _buckets(self, batch_id: int) -> list[int]:
        names = list_names(self.spark, f"{self.path}/delta/batch_id={batch_id}")
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("_bucket="))

    def _versions(self) -> list[int]:
        """Published versions."""
        names = list_names(self.spark, f"{self.path}/manifest")
        return sorted(int(n.split("=")[1]) for n in names if path_exists(self.spark, f"{self.path}/manifest/{n}/_SUCCESS"))

    def _state(self, version: int) -> tuple[int, int, dict[int, int]]:
        rows = self.spark.read.schema("bucket long, version int, upto long").json(f"{self.path}/manifest/version={version:08d}").collect()
        return version, max(r.upto for r in rows), {r.bucket: r.version for r in rows}

    def _newest(self) -> tuple[int, int, dict[int, int]]:
        versions = self._versions()
        return self._state(versions[-1]) if versions else (0, -1, {})
