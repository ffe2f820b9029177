"""Approximate nearest neighbours by learned partitions.

Fitted on a bounded sample: the sample's neighbour graph is cut into balanced
partitions (graph growing, then size-constrained label propagation), and a small
neural classifier learns which partitions hold the neighbours of a vector. Every
row of the table is indexed under its most probable partition; a query goes to
its most probable partitions and is reranked there by exact distances.

A partition is split into blocks whose number follows its size, and so are the
queries that it gets, so one crowded partition (many equal vectors) is many
bounded tasks. Each task returns its nearest ``k`` for each query; those are merged.

Defined results: vectors that are NULL, zero, of another length than most, or
hold a NULL or non-finite component take no part, neither do NULL ids; ties go to
the smaller id; a repeated id counts as one vector for each row but never as its
own neighbour; fewer candidates than ``k`` are all returned if all partitions are
probed, as is done for small tables; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convoy.llm.common import cut


@dataclass
class Params:
    """``sample`` bounds the rows the partitions are learnt from. ``recall`` is
    what rows kept back from the fit must reach among the sample: it fixes the
    number of partitions a query is sent to (many where vectors have no structure
    to learn, as for random directions; few for clustered ones)."""

    sample: int = 12_000
    rows: int = 100  # rows a partition should hold, up to
    most: int = 128  # partitions: the sample must show each of them
    recall: float = 0.97
    k: int = 10
    block: int = 4096
    hidden: int = 96
    degree: int = 12
    epochs: int = 40


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v)`` of the vectors that take part, as doubles."""
    v = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        & F.exists("v", lambda x: x != 0))
    dim = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return v.filter(F.size("v") == (dim[0]["d"] if dim else 0))


def nearest(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows of every row of a bounded sample, in blocks."""
    sq, out = (x * x).sum(1), np.zeros((len(x), k), np.int64)
    for s in range(0, len(x), 512):
        d = sq[None] - 2 * x[s:s + 512] @ x.T
        d[np.arange(len(d)), np.arange(s, s + len(d))] = np.inf
        out[s:s + 512] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_partition(graph: np.ndarray, n_parts: int, rounds: int = 12, slack: float = 1.15, seed: int = 3) -> np.ndarray:
    """Parts of nearly equal size with few cut edges: parts are grown along the
    graph one after another, then rows move to the part most of their neighbours
    are in while that part has room."""
    n, r = len(graph), np.random.default_rng(seed)
    both = [list(x) for x in graph]
    for i, row in enumerate(graph):
        for j in row:
            both[j].append(i)
    part, size, at = np.full(n, -1), -(-n // n_parts), 0
    order, edge, grown = iter(r.permutation(n)), [], 0
    while grown < n:
        i = edge.pop(0) if edge else next(order)
        if part[i] >= 0:
            continue
        part[i] = at
        grown += 1
        edge += [j for j in both[i] if part[j] < 0]
        if grown % size == 0:
            at, edge = at + 1, []
    load, room = np.bincount(part, minlength=n_parts), int(size * slack) + 1
    for _ in range(rounds):
        moved = 0
        for i in r.permutation(n):
            near = np.bincount(part[both[i]], minlength=n_parts)
            near[(load >= room) & (np.arange(n_parts) != part[i])] = -1
            best = int(near.argmax())
            if near[best] > near[part[i]]:
                load[part[i]] -= 1
                load[best] += 1
                part[i] = best
                moved += 1
        if moved < n // 200:
            break
    return part


class Router:
    """One hidden layer, softmax over partitions; learns each row's share of neighbours by partition."""

    def __init__(self, x: np.ndarray, target: np.ndarray, p: Params, seed: int = 5):
        r = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std() + 1e-12
        x, n, d, out = (x - self.mean) / self.scale, *x.shape, target.shape[1]
        w = [r.normal(0, d ** -0.5, (d, p.hidden)), np.zeros(p.hidden), r.normal(0, p.hidden ** -0.5, (p.hidden, out)), np.zeros(out)]
        m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for epoch in range(p.epochs):
            for s in np.array_split(r.permutation(n), max(1, n // 128)):
                h = np.maximum(x[s] @ w[0] + w[1], 0)
                z = h @ w[2] + w[3]
                z = np.exp(z - z.max(1, keepdims=True))
                e = (z / z.sum(1, keepdims=True) - target[s]) / len(s)
                back = (e @ w[2].T) * (h > 0)
                t += 1
                rate = 0.004 * (1 - epoch / p.epochs) + 1e-4
                for i, g in enumerate((x[s].T @ back, back.sum(0), h.T @ e, e.sum(0))):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    w[i] -= rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        self.w = w

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.scale
        z = np.maximum(x @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def fit(vectors: DataFrame, p: Params) -> tuple[Router | None, int, int]:
    """Router, number of partitions, and of those a query is sent to; None for a
    table small enough for a single one."""
    rows = vectors.count()
    n_parts = min(p.most, rows // p.rows)
    if n_parts < 2:
        return None, 1, 1
    # p.sample rows at most
    x = np.array([r["v"] for r in vectors.orderBy(F.xxhash64("id"), "id").limit(p.sample).select("v").collect()])
    x = np.random.default_rng(7).permutation(np.unique(x, axis=0))
    n_parts = min(n_parts, len(x) // 40)
    if n_parts < 2:
        return None, 1, 1
    kept = len(x) // 12
    back, x = x[:kept], x[kept:]
    graph = nearest(x, min(p.degree, len(x) - 1))
    part = balanced_partition(graph, n_parts)
    target = np.zeros((len(x), n_parts))
    np.add.at(target, (np.arange(len(x))[:, None], part[graph]), 1.0)
    target[np.arange(len(x)), part] += 2
    model = Router(x, target / target.sum(1, keepdims=True), p)
    # place of the partition of each near row in the order in which it would be probed
    near = np.argsort((x * x).sum(1)[None] - 2 * back @ x.T, axis=1)[:, :p.k]
    place = np.argsort(np.argsort(-model(back), axis=1, kind="stable"), axis=1)
    at = np.sort(place[np.arange(kept)[:, None], model(x).argmax(1)[near]].ravel())
    return model, n_parts, int(at[min(len(at) - 1, int(np.ceil(p.recall * len(at))))]) + 1


def _route(model, probes: int):
    """The ``probes`` most probable partitions of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            if model is None:
                b["parts"] = [[0]] * len(b)
            else:
                prob = model.value(np.array(b["v"].tolist()))
                b["parts"] = np.argsort(-prob, axis=1, kind="stable")[:, :probes].tolist()
            yield b

    return run


def _search(k: int):
    def run(key: tuple, asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(rows):
            rows = rows.sort_values("id")
            x, ids = np.array(rows["v"].tolist()), rows["id"].to_numpy()
            q, qid = np.array(asked["v"].tolist()), asked["id"].to_numpy()
            sq = (x * x).sum(1)
            for s in range(0, len(q), 256):
                near = sq[None] - 2 * q[s:s + 256] @ x.T  # ranks like the distance, up to rounding
                near[qid[s:s + 256, None] == ids[None]] = np.inf
                kth = np.partition(near, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1]
                for i, d in enumerate(near):
                    c = np.flatnonzero((d <= kth[i] + 1e-9 * (abs(kth[i]) + sq.max() + 1)) & np.isfinite(d))
                    exact = np.sqrt(((x[c] - q[s + i]) ** 2).sum(1))
                    best = np.lexsort((ids[c], exact))[:k]
                    out += zip([qid[s + i]] * len(best), ids[c[best]], exact[best])
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def search(vectors: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int = 10, p: Params | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of ``vectors``
    found for each id of ``queries`` (rows of the same id left out; of several vectors
    of one id the least, element by element, is asked)."""
    p, spark = p or Params(), vectors.sparkSession
    rows, asked = usable(vectors, id_col, vec_col), usable(queries, id_col, vec_col)
    model, _, probes = fit(rows, p)
    model = None if model is None else spark.sparkContext.broadcast(model)  # of fixed size
    schema = "id long, v array<double>, parts array<int>"
    rows = rows.mapInPandas(_route(model, 1), schema).select("id", "v", F.explode("parts").alias("part"))
    asked = asked.groupBy("id").agg(F.min("v").alias("v")).mapInPandas(_route(model, probes), schema).select("id", "v", F.explode("parts").alias("part"))
    rows, asked = cut(rows), cut(asked)
    blocks = lambda df, name: df.groupBy("part").agg(F.ceil(F.count("*") / p.block).cast("int").alias(name))
    # a row a partition: p.most at most
    split = F.broadcast(blocks(rows, "_r").join(blocks(asked, "_q"), "part"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    rows = rows.join(split, "part").select("id", "v", "part", mine("_r").alias("r"), every("_q").alias("q"))
    asked = asked.join(split, "part").select("id", "v", "part", mine("_q").alias("q"), every("_r").alias("r"))
    keys = ["part", "r", "q"]
    found = asked.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(_search(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
