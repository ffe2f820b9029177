"""Mixing sources to target weights with pivotal dependent rounding.

Every source gets a target number of words (:func:`targets`). A document's
expected number of copies is its source's target over its source's size; the
whole part is certain and the fraction is rounded by the pivotal method: two
fractions meet, mass moves from one to the other at random until one of them is
0 or 1, and the other goes on. Documents meet their neighbours in size, so that
the words taken stay close to the target and not only the number of documents.

Documents are split into groups (source, size class, salt) whose count follows
the data; each group leaves at most one fractional document, and those residuals
meet in a reduction tree up to one group for each source. There the pivotal
draw is repeated and the draw whose words come nearest the target is taken
(rejective sampling). All draws are seeded by the group, so reruns agree.

Defined results: NULL or blank text has size 0 and takes 0 words; a NULL source
is a source of its own, ordered last; repeated rows are separate documents; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convoy.llm.common import cut

#: Documents in one rounding group; residual groups met in one tree node.
GROUP, FAN_IN = 2_000, 256
#: Draws compared where a source's last residuals are rounded.
DRAWS = 512


def sized(docs: DataFrame) -> DataFrame:
    n = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select("doc_id", "source", F.coalesce(n, F.lit(0)).cast("long").alias("size"), F.xxhash64("doc_id", "text").alias("_h"))


def targets(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """``(source, source_size, target, n)`` for ``sizes(source, size)``.

    Sources by code point, NULL last, take ``weights`` in turn; together they get
    ``share`` of all words. A source stops at ``most`` times its size; with the
    stop levels in order, the level of all sources that don't stop is the first
    one that the next stop doesn't undercut. One row a source is windowed.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn % len(weights) + 1).cast("int"))
    by = by.withColumn("w", w).withColumn("stop", F.lit(float(most)) * F.col("source_size"))
    up = Window.orderBy(F.col("stop") / F.col("w"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    spent = F.coalesce(F.sum("stop").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(whole) * float(share) - spent) / left
    by = by.withColumn("level", level)
    first = F.max(F.when(F.col("stop") / F.col("w") >= F.col("level"), F.col("level"))).over(whole)
    return by.withColumn("first", first).select(
        "source", "source_size", "n",
        F.when(F.col("first").isNull(), F.col("stop")).otherwise(F.least("stop", F.col("first") * F.col("w"))).alias("target"))


def pivotal(p: np.ndarray, draw: np.random.Generator) -> tuple[np.ndarray, int]:
    """Round the fractions ``p`` in their order; returns 0/1 (and a fraction at
    the returned position, -1 if none is left). Expectations are kept."""
    p, u, eps = p.tolist(), draw.random(len(p)).tolist(), 1e-9
    at = -1
    for j, b in enumerate(p):
        if b < eps or b > 1 - eps:
            p[j] = float(b > 0.5)
            continue
        if at < 0:
            at = j
            continue
        a, s = p[at], p[at] + b
        if s < 1:
            if u[j] * s < b:
                p[at], p[j], at = 0.0, s, j
            else:
                p[at], p[j] = s, 0.0
        else:
            s -= 1
            if u[j] * (1 - s) < 1 - b:
                p[at], p[j], at = 1.0, s, j
            else:
                p[at], p[j] = s, 1.0
        if p[at] < eps or p[at] > 1 - eps:
            p[at], at = float(p[at] > 0.5), -1
    return np.array(p, float), at


def _seed(row: pd.DataFrame, keys: list[str], level: int) -> int:
    return zlib.crc32(repr((level, [str(row[k].iloc[0]) for k in keys])).encode())


def _round(df: DataFrame, keys: list[str], level: int) -> DataFrame:
    """Round within each group of ``keys``: ``p`` becomes 0 or 1, but for one row at most."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["size", "_h", "_k"], kind="stable")
        g["p"] = pivotal(g["p"].to_numpy(), np.random.default_rng(_seed(g, keys, level)))[0]
        return g

    return df.groupBy(*keys).applyInPandas(run, df.schema)


def _settle(df: DataFrame) -> DataFrame:
    """The last residuals of a source: of ``DRAWS`` pivotal draws the one nearest to ``gap``."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["size", "_h", "_k"], kind="stable")
        p, size, gap = g["p"].to_numpy(), g["size"].to_numpy(float), g["gap"].iloc[0]
        draw, best = np.random.default_rng(_seed(g, ["_s"], 99)), None
        for _ in range(DRAWS):
            x, at = pivotal(p, draw)
            if at >= 0:
                x[at] = float(draw.random() < x[at])
            miss = abs((x * size).sum() - gap)
            if best is None or miss < best[0]:
                best = miss, x
        g["p"] = best[1]
        return g

    return df.groupBy("_s").applyInPandas(run, df.schema)


def mix(docs: DataFrame, weights: list[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row
    of ``docs(doc_id, text, source)``; taken = copies * size."""
    sizes = sized(docs)
    goal = cut(targets(sizes, list(weights), share, most))
    per = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # one row a source; the join is left to the planner's size check
    d = sizes.join(goal.withColumnRenamed("source", "_g"), sizes["source"].eqNullSafe(F.col("_g")), "left").drop("_g")
    d = d.withColumn("base", F.floor(per)).withColumn("p", per - F.floor(per))
    d = d.withColumn("p", F.when(F.col("size") == 0, F.lit(0.0)).otherwise(F.col("p")))
    d = d.withColumn("_s", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))
    d = d.withColumn("_k", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    d = d.withColumn("_c", F.floor(F.log2(F.col("size") + 1) * 2).cast("int"))
    d = d.withColumn("_n", F.ceil(F.col("n") / GROUP).cast("long"))
    d = d.withColumn("_t", F.pmod(F.col("_h"), F.col("_n")))
    widest = goal.agg(F.max(F.ceil(F.col("n") / GROUP))).first()[0] or 1
    done, level = [], 0
    d = cut(_round(d, ["_s", "_c", "_t"], level))
    while True:
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(d.filter(~open_))
        d = d.filter(open_)
        if widest <= 1:
            break
        widest, level = -(-widest // FAN_IN), level + 1
        d = cut(_round(d.withColumn("_t", F.floor(F.col("_t") / FAN_IN)), ["_s", "_c", "_t"], level))
    fixed = done[0]
    for x in done[1:]:
        fixed = fixed.unionByName(x)
    fixed = fixed.withColumn("copies", F.col("base") + F.col("p").cast("long"))
    taken = fixed.groupBy("_s").agg(F.sum(F.col("copies") * F.col("size")).alias("_taken"))
    last = d.join(taken, "_s", "left").withColumn(
        "gap", F.col("target") - F.coalesce("_taken", F.lit(0)) - F.sum(F.col("base") * F.col("size")).over(Window.partitionBy("_s")))
    last = _settle(last.drop("_taken")).drop("gap")
    last = last.withColumn("copies", F.col("base") + F.col("p").cast("long"))
    return fixed.unionByName(last).select(
        "doc_id", "source", "size", "source_size", "target", F.col("copies").cast("long").alias("copies"),
        (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as ``mixed`` says. Rows of equal id, source
    and size are told apart by the order of their texts' hashes, so each row gets one
    decision, the same on every run."""
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    rows = docs.select(F.struct("*").alias("record"), "doc_id", "source", size.alias("size"), F.xxhash64("text").alias("t"))
    same = Window.partitionBy("doc_id", "source", "size").orderBy
    left = rows.withColumn("i", F.row_number().over(same("t")))
    right = mixed.withColumn("i", F.row_number().over(same("copies"))).filter("copies > 0").select(
        F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("size").alias("z"), F.col("i").alias("j"), F.col("copies").cast("int").alias("copies"))
    both = left.join(right, left["doc_id"].eqNullSafe(right["d"]) & left["source"].eqNullSafe(right["s"])
                     & (left["size"] == right["z"]) & (left["i"] == right["j"]))
    return both.select("record", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("record.*")
