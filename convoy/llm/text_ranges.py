"""Ranges of whole texts by adaptive prefixes.

Bounds are taken from a sorted sample of distinct texts: every so many texts, the
shortest beginning that tells a text from the one before it. Texts that share a
header, however long, thus still fall into different ranges, and a bound is no
longer than it has to be. The sample decides about the balance of the ranges
alone, never about a result; its size is a number a range.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut, lean, parts
from convoy.llm.text_trie import common

#: Sampled texts a range, and ranges that one task finds bounds for.
A_RANGE, COARSE = 16, 64


def _chosen(batches):
    """Bounds from texts that come sorted within ``r``."""
    r, before, n = None, None, 0
    for b in batches:
        out = []
        for at, text in zip(b["r"].to_pylist(), b["b"].to_pylist()):
            if at != r:
                r, n = at, 0
            if n and n % A_RANGE == 0:
                out.append(text[:common(before, text) + 1])
            before, n = text, n + 1
        yield pa.RecordBatch.from_pydict({"b": pa.array(out, pa.binary())})


def _dealt(coarse: list[bytes]):
    def run(batches):
        for b in batches:
            r = [bisect_right(coarse, x) for x in b["b"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(r, pa.int32()), b["b"]], names=["r", "b"])

    return run


def _sorted(texts: DataFrame, width: int) -> list[bytes]:
    spread = texts.repartition(width, "r").sortWithinPartitions("r", "b")
    return [bytes(r.b) for r in spread.mapInArrow(lean(_chosen), "b binary").collect()]


def bounds(texts: DataFrame, col: str, ranges: int) -> list[bytes]:
    """Ascending bounds over the distinct values of ``col`` (string, NULLs left out) for
    about ``ranges`` ranges (fewer where texts repeat); a text belongs to range
    ``bisect_right(bounds, text)``.
    """
    every = max(1, texts.count() // (A_RANGE * ranges))
    drawn = texts.select(F.col(col).cast("binary").alias("b")).filter(F.col("b").isNotNull())
    drawn = cut(drawn.filter(F.pmod(F.xxhash64("b"), F.lit(every)) == 0).distinct())
    # a small part of the sample deals the rest to tasks that sort it
    few = max(1, drawn.count() // (A_RANGE * COARSE))
    part = drawn.filter(F.pmod(F.xxhash64(F.lit(1), "b"), F.lit(few)) == 0)
    coarse = _sorted(part.select(F.lit(0).alias("r"), "b"), 1)
    fine = _sorted(drawn.mapInArrow(lean(_dealt(coarse)), "r int, b binary"), parts(texts))
    return sorted({*coarse, *fine})
