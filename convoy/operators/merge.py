"""Set-based merges on plain parquet tables (no MERGE statement needed).

* :func:`insert_missing` - ``MERGE ... WHEN NOT MATCHED THEN INSERT``:
  target rows plus source rows whose key is absent (left anti join + union).
* :func:`latest_per_key` - keep the newest row per key (retries and replays
  collapse to one row; the last write wins on the full key).
* :func:`upsert` - last write wins per key across target and updates.
* :func:`scd2_apply` - slowly changing dimension type 2: unchanged rows stay,
  changed rows are closed at the batch date and reopened with new values,
  new keys are opened, history passes through. Validity is half-open
  ``[valid_from, valid_to)`` with an open end of 2262-04-11.

All of them are joins on the business key, so they shuffle by that key only.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convoy.functions.columns import OPEN_VALID_TO


def surrogate_key(*cols) -> Column:
    """Stable 64-bit surrogate key from business columns (no global sort)."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    new = source.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


def latest_per_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Newest row per key; ties broken by the full row for determinism.

    Implemented as ``max_by`` over a struct: partial aggregation, so a hot
    key does not gather its rows in one task.
    """
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    newest = F.max_by(packed, F.struct(F.col(order_col), F.hash(packed), F.xxhash64(packed)))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    return latest_per_key(target.unionByName(updates.select(*target.columns)), keys, order_col)


def scd2_apply(dim: DataFrame | None, snapshot: DataFrame, key: str, tracked: list[str],
               batch_date, surrogate: str, type1: list[str] | None = None) -> DataFrame:
    """Apply one snapshot of a source table to a type-2 dimension.

    ``dim`` has the snapshot columns plus ``surrogate``, ``valid_from``,
    ``valid_to``, ``is_current``; ``None`` starts a new dimension.
    Columns are compared one by one, NULL equal to NULL. A second change on the
    day a version was opened replaces that version in place.
    A change in a ``tracked`` column closes the current version and opens a
    new one; ``type1`` columns are overwritten in the current version
    without a new one (derived ratings, for example). Keys missing from the
    snapshot stay open (the source never deletes).
    """
    d = F.lit(batch_date).cast("date") if isinstance(batch_date, str) else batch_date
    attrs = [c for c in snapshot.columns if c != key]

    def opened(df: DataFrame) -> DataFrame:
        return df.select(
            surrogate_key(key, d).alias(surrogate), key, *attrs,
            d.alias("valid_from"), F.lit(OPEN_VALID_TO).cast("date").alias("valid_to"),
            F.lit(True).alias("is_current"))

    if dim is None:
        return opened(snapshot)

    cols = dim.columns
    history = dim.where(~F.col("is_current"))
    current = dim.where(F.col("is_current"))
    old = current.select(key, *[F.col(c).alias(f"_o_{c}") for c in tracked], F.lit(True).alias("_old"))
    seen = snapshot.select(key, *[F.col(c).alias(f"_n_{c}") for c in tracked], F.lit(True).alias("_new"))
    both = old.join(seen, key, "full_outer")
    same = reduce(and_, [F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}")) for c in tracked], F.lit(True))
    changed_keys = both.where(F.col("_old") & F.col("_new") & ~same).select(key)
    new_keys = both.where(F.col("_old").isNull()).select(key)

    keep = current.join(changed_keys, key, "left_anti")
    if type1:
        fresh = snapshot.select(key, *[F.col(c).alias(f"_t1_{c}") for c in type1])
        keep = keep.join(fresh, key, "left")
        for c in type1:
            keep = keep.withColumn(c, F.coalesce(F.col(f"_t1_{c}"), F.col(c))).drop(f"_t1_{c}")
    # a version opened on the batch date itself is replaced, not closed: it has
    # no day of its own and would share its key with the new one
    closed = (current.where(F.col("valid_from") < d).join(changed_keys, key, "left_semi")
              .withColumn("valid_to", d).withColumn("is_current", F.lit(False)))
    reopened = opened(snapshot.join(changed_keys.unionByName(new_keys), key, "left_semi"))
    if type1:  # a type 1 value that the snapshot doesn't have stays
        last = current.select(key, *[F.col(c).alias(f"_t1_{c}") for c in type1])
        reopened = reopened.join(last, key, "left")
        for c in type1:
            reopened = reopened.withColumn(c, F.coalesce(F.col(c), F.col(f"_t1_{c}"))).drop(f"_t1_{c}")
    return (history.unionByName(keep.select(*cols)).unionByName(closed.select(*cols))
            .unionByName(reopened.select(*cols)))


def point_in_time(facts: DataFrame, dim: DataFrame, key: str, at: str, surrogate: str,
                  unknown: int = -1) -> DataFrame:
    """Attach the surrogate key of the dimension version valid at ``at``
    (``valid_from <= at < valid_to``; a key's versions don't overlap). Facts
    without a matching version get the unknown member key.

    Facts and versions are merged in one ordered pass for each key and month, the
    last version carried forward, so no pairs of facts and versions are formed. What
    is valid when a month begins is carried in from a pass over the versions and the
    months that have facts alone; a key's facts are thus spread over their months.
    """
    day = F.to_date(F.col(at))
    versions = dim.select(F.col(key).alias("_k"), F.col("valid_from").alias("_at"),
                          F.struct(F.col(surrogate).alias("sk"), "valid_to").alias("_version"))
    none = F.lit(None).cast(versions.schema["_version"].dataType)
    stream = facts.withColumn("_k", F.col(key)).withColumn("_at", day).withColumn("_month", F.trunc("_at", "month"))
    begun = stream.where(F.col("_k").isNotNull() & F.col("_month").isNotNull()).select(
        "_k", F.col("_month").alias("_at")).distinct().select("*", none.alias("_version"))

    def carried(*by: str) -> Column:
        # versions come before the marks and facts of their day
        order = Window.partitionBy(*by).orderBy("_at", F.col("_version").isNull())
        return F.last("_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))

    marks = versions.select(*begun.columns).unionByName(begun).withColumn("_carried", carried("_k"))
    opening = marks.where(F.col("_version").isNull() & F.col("_carried").isNotNull()).select("_k", "_at", F.col("_carried").alias("_version"))
    # a version that begins on the first of a month is its own opening, too
    known = versions.unionByName(opening).distinct().withColumn("_month", F.trunc("_at", "month")).withColumn("_fact", F.lit(False))
    merged = stream.withColumn("_version", none).withColumn("_fact", F.lit(True)).unionByName(known, allowMissingColumns=True)
    found = merged.withColumn("_found", carried("_k", "_month")).where("_fact")
    valid = F.when(F.col("_at") < F.col("_found.valid_to"), F.col("_found.sk"))
    out = found.withColumn(surrogate, F.coalesce(valid, F.lit(unknown).cast("bigint")))
    return out.select(*facts.columns, surrogate)
