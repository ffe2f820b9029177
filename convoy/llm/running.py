"""Running counts, sums and exclusive-ors along keys of any length.

Rows are range-partitioned by key and order, so a long key lies in several
partitions; each partition is scanned once, and what a key has gathered in
earlier partitions is added afterwards. There is at most one such carry for a
partition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut, lean, parts


def _scan(key: str, xor: list[str], add: list[str], keep: list[str]):
    ops = [np.bitwise_xor] * len(xor) + [np.add] * len(add)
    undo = [np.bitwise_xor] * len(xor) + [np.subtract] * len(add)

    def run(batches):
        pid, last, state = TaskContext.get().partitionId(), None, [0] * (1 + len(ops))
        for b in batches:
            if not b.num_rows:
                continue
            k = b[key].to_numpy(zero_copy_only=False)
            first = np.concatenate([[True], k[1:] != k[:-1]])
            start = np.flatnonzero(first)[np.cumsum(first) - 1]  # row where the key of each row begins
            carried = (start == 0) & (k == last) if last is not None else np.zeros(len(k), bool)
            values = [np.ones(len(k), np.int64), *(b[c].to_numpy(zero_copy_only=False) for c in xor + add)]
            out = []
            for v, op, back, held in zip(values, [np.add, *ops], [np.subtract, *undo], state):
                total = op.accumulate(v)
                own = back(total, np.where(start > 0, total[start - 1], 0))
                out.append(np.where(carried, op(own, held), own))
            last, state = k[-1], [o[-1] for o in out]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in keep), pa.array(np.full(len(k), pid, np.int32)), *map(pa.array, out)],
                                             names=[*keep, "_pid", "_n", *(f"run_{c}" for c in xor + add)])

    return run


def running(df: DataFrame, key: str, order: list[Column], keep: list[str], xor: list[str] = (), add: list[str] = ()) -> DataFrame:
    """``keep`` columns, ``n`` (the row's number along ``key`` in ``order``, from 1) and
    ``run_<c>`` for each long column of ``xor`` and ``add``: combined over the rows of
    the key up to this one. ``key`` is a long without NULLs; rows that
    ``order`` does not tell apart must be equal."""
    spark, xor, add = df.sparkSession, list(xor), list(add)
    kept = list(dict.fromkeys([key, *keep]))
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    names = ["_n", *(f"run_{c}" for c in xor + add)]
    ddl = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "_pid int", *(f"{c} long" for c in names)])
    # rand: equal rows need not lie in one partition
    ranged = df.repartitionByRange(parts(df), key, *order, F.rand(1)).sortWithinPartitions(key, *order)
    local = cut(ranged.select(*dict.fromkeys([*kept, *xor, *add])).mapInArrow(lean(_scan(key, xor, add, kept)), ddl))
    at = F.struct(key, "_n")
    ends = local.groupBy("_pid").agg(F.min(key).alias("first"), F.max(key).alias("last"), *(F.max_by(c, at).alias(c) for c in names))
    held, gathered, carries = None, None, []
    for r in sorted(ends.collect()):  # one row for each partition
        own = [r[c] for c in names]
        if r["first"] == held:
            carries.append((r["_pid"], held, *gathered))
        if r["last"] == held:
            own = [_xor(a, b) if c in [f"run_{x}" for x in xor] else a + b for c, a, b in zip(names, own, gathered)]
        held, gathered = r["last"], own
    if carries:
        more = spark.createDataFrame(carries, ", ".join(["_pid int", f"`{key}` {types[key]}", *(f"c{c} long" for c in names)]))
        local = local.join(F.broadcast(more), ["_pid", key], "left")
        for c in names:
            held = F.coalesce(F.col(f"c{c}"), F.lit(0).cast("long"))
            local = local.withColumn(c, F.col(c).bitwiseXOR(held) if c[4:] in xor else F.col(c) + held)
    return local.select(*kept, F.col("_n").alias("n"), *names[1:])


def _xor(a: int, b: int) -> int:
    return a ^ b  # of signed 64-bit values it is one again
