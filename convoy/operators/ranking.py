"""Distributed ``rank() over (order by v)``.

A window with an ORDER BY and no PARTITION BY moves every row into one task.
:func:`rank_table` gives the same numbers without that:

1. collapse rows to distinct values with their multiplicity (partial
   aggregation, so a value held by a third of the rows becomes one row);
2. rank = 1 + the rows of all smaller values: a running total over range
   partitions whose number follows the data (:mod:`convoy.operators.prefix`).

:func:`with_ranks` joins one or more such rank tables back to the rows on
the value. Ties share a rank and the next rank skips, exactly as ``rank()``.
NULL keys sort last for ascending and first for descending order (the
PostgreSQL default) unless ``nulls_last`` is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.operators.lineage import materialize
from convoy.operators.prefix import running_totals


def rank_table(df: DataFrame, key: str, ascending: bool = True, nulls_last: bool | None = None) -> DataFrame:
    """Distinct values of ``key`` with their rank: columns ``(_v, _rank)``."""
    if nulls_last is None:
        nulls_last = ascending
    counts = df.groupBy(F.col(key).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    v = F.col("_v")
    order = {(True, True): v.asc_nulls_last(), (True, False): v.asc_nulls_first(),
             (False, True): v.desc_nulls_last(), (False, False): v.desc_nulls_first()}[ascending, nulls_last]
    return running_totals(counts, [order], {"_n": "_before"}).select("_v", (F.col("_before") + 1).alias("_rank"))


_EXACT_IN_DOUBLE = {"tinyint", "smallint", "int", "float", "double"}


def with_ranks(df: DataFrame, specs: list[tuple[str, str, bool]],
               row_key: str | None = None) -> DataFrame:
    """Add ``rank() over (order by key asc|desc)`` columns.

    ``specs`` is a list of ``(key, output_column, ascending)``. When every key
    is exactly representable as a double, all keys are ranked in one pass
    (:func:`_stacked_rank_table`); otherwise one :func:`rank_table` per key.
    Ranks are joined back on the (NULL-safe) value. With a ``row_key`` that
    is unique per row, the stacked ranks are joined back in one join and
    pivoted per row (the rank table is then read once).
    """
    types = dict(df.dtypes)
    stackable = len(specs) > 1 and all(types[k] in _EXACT_IN_DOUBLE for k, _, _ in specs)
    if stackable and row_key is not None:
        return _with_ranks_keyed(df, specs, row_key)
    if stackable:
        # One row per (key, distinct value), read by one join per key: written
        # once, otherwise each join would re-run the whole ranking (the
        # per-key filter is pushed below the windows, so plans differ).
        ranked = materialize(_stacked_rank_table(df, specs))
        out = df
        for i, (key, name, _) in enumerate(specs):
            rt = ranked.where(F.col("_m") == i).select(F.col("_v").alias("_rv"),
                                                       F.col("_rank").alias(name))
            out = out.join(rt, F.col(key).cast("double").eqNullSafe(F.col("_rv")), "left").drop("_rv")
        return out
    out = df
    for key, name, asc in specs:
        rt = rank_table(df, key, ascending=asc)
        out = (out.join(rt, out[key].eqNullSafe(rt["_v"]), "left")
               .withColumnRenamed("_rank", name).drop("_v"))
    return out


def _signed(specs: list[tuple[str, str, bool]]) -> list:
    return [F.col(k).cast("double") if asc else -F.col(k).cast("double") for k, _, asc in specs]


def _with_ranks_keyed(df: DataFrame, specs: list[tuple[str, str, bool]], row_key: str) -> DataFrame:
    """Stacked ranks joined back through the stacked rows ``(row_key, _m,
    _v)`` and pivoted to one column per key."""
    ranked = _stacked_rank_table(df, specs)
    stacked = df.select(row_key, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_sm"), F.col(k).cast("double").alias("_sv"))
        for i, (k, _, _) in enumerate(specs)])).alias("_s")).select(row_key, "_s.*")
    j = stacked.join(ranked, (F.col("_sm") == F.col("_m")) & F.col("_sv").eqNullSafe(F.col("_v")),
                     "left")
    pivot = j.groupBy(row_key).agg(*[
        F.max(F.when(F.col("_sm") == i, F.col("_rank"))).alias(name)
        for i, (_, name, _) in enumerate(specs)])
    return df.join(pivot, row_key)


def _stacked_rank_table(df: DataFrame, specs: list[tuple[str, str, bool]]) -> DataFrame:
    """Ranks of several numeric keys at once: rows ``(_m, _v, _rank)`` with
    ``_m`` the spec index and ``_v`` the key value as double.

    Descending keys are ranked as ascending on ``-v``, with NULLs first instead of last.
    """
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("_m"), o.alias("_o")) for i, o in enumerate(_signed(specs))
    ])).alias("_s")).select("_s.*")
    counts = stacked.groupBy("_m", "_o").agg(F.count(F.lit(1)).alias("_n"))
    per_spec = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("_m") + 1)
    nulls = F.when(F.col("_o").isNull(), per_spec([1 if asc else -1 for _, _, asc in specs])).otherwise(F.lit(0))
    totals = running_totals(counts, [F.col("_m"), nulls, F.col("_o")], {"_n": "_before"})
    # rows before a key's own: one row for each key
    first = F.broadcast(totals.groupBy("_m").agg(F.min("_before").alias("_first")))
    return totals.join(first, "_m").select(
        "_m", (F.col("_o") * per_spec([1.0 if asc else -1.0 for _, _, asc in specs])).alias("_v"),
        (F.col("_before") - F.col("_first") + 1).alias("_rank"))


def global_rank(df: DataFrame, key: str, out: str, ascending: bool = True) -> DataFrame:
    return with_ranks(df, [(key, out, ascending)])
