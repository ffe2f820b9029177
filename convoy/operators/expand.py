"""Row expansion and proportional allocation.

:func:`expand_range` turns a row with a count ``n`` into ``n`` rows numbered
``0 .. n-1`` in two steps - first into chunks of at most ``chunk`` numbers,
which are hash-distributed, then each chunk into its numbers - so a single row
with a very large ``n`` is spread over many tasks instead of being exploded
inside one.

:func:`allocate` splits a group total over its members in proportion to a
share column, using a group aggregate joined back (not a window), so a huge
group is summed by partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_CHUNK = 4096


def expand_range(df: DataFrame, n_col: str, out_col: str, keys: list[str],
                 chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """``keys`` identify the input row. Every row is cut into chunks of at most
    ``chunk`` numbers, the chunks are dealt by ``(keys, chunk number)``, and each
    is exploded where it lands."""
    n = F.col(n_col).cast("bigint")
    n_chunks = F.floor((n + F.lit(chunk - 1)) / F.lit(chunk)).cast("bigint")
    chunks = (df.where(n > 0)
              .withColumn("_c", F.explode(F.sequence(F.lit(0).cast("bigint"), n_chunks - 1)))
              .repartition(*keys, "_c"))
    lo = F.col("_c") * F.lit(chunk)
    hi = F.least(lo + F.lit(chunk), n) - F.lit(1)
    return chunks.withColumn(out_col, F.explode(F.sequence(lo, hi))).drop("_c")


def allocate(df: DataFrame, group: list[str], share: str, total: str, out: str,
             factor: float = 1.0, floor: float | None = None) -> DataFrame:
    """``out = share / sum(share) over group * total * factor``, at least ``floor``."""
    # Summed in the share's own type (exact for decimals), then as double.
    sums = df.groupBy(*group).agg(F.sum(F.col(share)).cast("double").alias("_sum"))
    x = df.join(sums, group)
    v = F.try_divide(F.col(share).cast("double"), F.col("_sum")) * F.col(total).cast("double") \
        * F.lit(factor)
    if floor is not None:
        v = F.greatest(v, F.lit(floor))
    return x.withColumn(out, v).drop("_sum")
