"""Toxicity scoring with a small convolutional text classifier.

Hashed word embeddings (a word is the sum of the embeddings of itself, of its
first four and of its first six bytes, so an unseen inflection of a known stem
still scores), filters of several widths, max pooling over the whole text and a
logistic output. It starts from a fit on a bounded set of labelled rows; then every
labelled row is learnt from on the executors, each task going over its own rows, and
the tasks' changes are averaged by Spark. Thresholds come from the counts of all rows set
aside for them. Scoring runs on the executors, one Arrow batch at a time.

Thresholds are calibrated by language: the language group of a text is read
from its function words (never from a ``lang`` column) and the score is
shifted so that each group's best threshold lands on ``cutoff``.

Defined results: NULL and empty texts are scored as a text without words; NULL
or repeated ``doc_id`` rows are scored row by row; extra columns are ignored;
labels that contradict each other count as toxic; an empty label table (or one
with a single class) gives the constant score 0.
"""

from __future__ import annotations

import copy
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import byte_slices, lean, split_words, trim
from convoy.operators.lineage import materialize

#: Frequent function words that tell the language group of a text.
FUNCTION_WORDS = {
    "de": "der die das und ist nicht ein eine den dem von mit sich auf für zu",
    "en": "the of and to is that it with was for on are this by from",
    "es": "el los las que y en por con una para del se su como más",
    "fr": "le les et des est une dans pour que qui sur pas au du ce",
    "it": "il di che non gli della per un sono con del alla",
    "pt": "o os não uma com para dos da em ao mais",
    "nl": "de het een van en niet zijn met voor aan ook",
}
GROUPS = [*FUNCTION_WORDS, ""]
_GROUP_OF: dict[bytes, int] = {}
for _i, _l in enumerate(FUNCTION_WORDS):
    for _w in FUNCTION_WORDS[_l].split():
        _GROUP_OF.setdefault(_w.encode(), _i)

#: A-Z to lower case, every other ASCII byte that is no letter or digit to a space.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32
               for b in range(256))


@dataclass
class Params:
    """``sample`` bounds the labelled rows of the first fit (two fifths of it at most
    toxic), not those learnt from; ``share`` is about the rows that one task learns from, each
    ``passes`` times."""

    sample: int = 8000
    bits: int = 17
    dim: int = 12
    filters: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    steps: int = 900
    batch: int = 64
    rate: float = 0.08
    cutoff: float = 0.3
    cache: int = 150_000
    share: int = 10_000
    passes: int = 4


class Vocabulary:
    """Word to row number, for one task; rows hold the hashed features."""

    def __init__(self, bits: int):
        self.mask, self.rows, self.feats, self.group = (1 << bits) - 1, {}, [], []

    def add(self, word: bytes) -> int:
        i = self.rows[word] = len(self.rows) + 1  # row 0 is the padding
        crc = zlib.crc32
        self.feats.append((crc(word) & self.mask, crc(word[:4], 7) & self.mask, crc(word[:6], 77) & self.mask))
        self.group.append(_GROUP_OF.get(word, -1))
        return i

    def encode(self, texts: pa.Array, pad: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of all words, ``pad`` zeros after each text, and each text's start."""
        get, add = self.rows.get, self.add
        pieces, codes, count = split_words(texts, lower=False)
        own = [[get(w) or add(w) for w in x.translate(_PLAIN).split()] for x in pieces]
        own.append([0] * pad)
        size = np.array([len(x) for x in own], np.int64)
        flat, start = np.array([i for x in own for i in x], np.int32), np.cumsum(size) - size
        stop = np.cumsum(count)
        at = np.insert(codes.astype(np.int64), stop, len(pieces))  # the padding after each text
        n = size[at]
        offset = np.cumsum(n) - n
        ids = flat[np.repeat(start[at] - offset, n) + np.arange(n.sum())]
        return ids, offset[np.r_[0, stop[:-1] + np.arange(1, len(stop))]] if len(stop) else np.zeros(0, np.int64)


class ConvNet:
    def __init__(self, p: Params, seed: int = 1):
        r = np.random.default_rng(seed)
        self.p, self.shift = p, np.zeros(len(GROUPS), np.float32)
        self.emb = r.normal(0, 0.015, (1 << p.bits, p.dim)).astype(np.float32)
        self.conv = [r.normal(0, (w * p.dim) ** -0.5, (w, p.dim, p.filters)).astype(np.float32) for w in p.widths]
        self.bias = np.zeros((len(p.widths), p.filters), np.float32)
        self.out = r.normal(0, 0.5, (len(p.widths), p.filters)).astype(np.float32)
        self.const = np.float32(-1)
        # squared gradients so far
        self.g_emb = np.full(len(self.emb), 1e-3, np.float32)
        self.g_conv, self.g_bias, self.g_out = [np.full_like(k, 1e-3) for k in self.conv], np.full_like(self.bias, 1e-3), np.full_like(self.out, 1e-3)

    def _arrays(self) -> list[np.ndarray]:
        return [self.emb, self.g_emb, *self.conv, *self.g_conv, self.bias, self.g_bias, self.out, self.g_out]

    def state(self) -> np.ndarray:
        """Everything that is learnt, in rows of ``dim`` numbers."""
        flat = np.concatenate([*(a.ravel() for a in self._arrays()), [self.const]]).astype(np.float32)
        return np.append(flat, np.zeros(-len(flat) % self.p.dim, np.float32)).reshape(-1, self.p.dim)

    def add(self, rows: np.ndarray, change: np.ndarray) -> None:
        """Change the numbers of :meth:`state` in some rows."""
        state = self.state()
        state[rows] += change.astype(np.float32)
        flat, at = state.ravel(), 0
        for a in self._arrays():
            a[...] = flat[at:at + a.size].reshape(a.shape)
            at += a.size
        self.const = flat[at]

    @property
    def pad(self) -> int:
        return max(self.p.widths)

    def vectors(self, feats: np.ndarray) -> np.ndarray:
        """Embedding of each vocabulary row; row 0 (padding) is zero."""
        e = self.emb[feats[:, 0]] + self.emb[feats[:, 1]] + self.emb[feats[:, 2]]
        return np.vstack([np.zeros((1, self.p.dim), np.float32), e])

    def maps(self, vec: np.ndarray, ids: np.ndarray) -> Iterator[np.ndarray]:
        """For each width the filter responses at every position."""
        n = len(ids) - self.pad + 1
        for w, k in zip(self.p.widths, self.conv):
            c = np.zeros((n, self.p.filters), np.float32)
            for j in range(w):
                c += (vec @ k[j])[ids[j:j + n]]
            yield c

    def pooled(self, vec, ids, starts) -> np.ndarray:
        # a text's windows end before the next text: one window of padding alone belongs to each
        ends = np.append(starts[1:], len(ids)) - self.pad + 1
        at = np.stack([starts, ends], 1).ravel()[:-1]
        return np.stack([np.maximum.reduceat(c, at, axis=0)[::2] for c in self.maps(vec, ids)], axis=1)

    def logits(self, vec, ids, starts) -> np.ndarray:
        m = np.maximum(self.pooled(vec, ids, starts) + self.bias, 0)
        return (m * self.out).sum((1, 2)) + self.const

    def fit(self, texts: list[bytes], toxic: np.ndarray, seed: int = 2) -> None:
        """Class-balanced batches drawn from the rows."""
        p, r = self.p, np.random.default_rng(seed)
        yes, no = np.flatnonzero(toxic == 1), np.flatnonzero(toxic == 0)
        half = p.batch // 2
        self.learn(texts, toxic, (np.concatenate([r.choice(yes, half), r.choice(no, half)]) for _ in range(p.steps)))

    def learn(self, texts: list[bytes], toxic: np.ndarray, picks: Iterable[np.ndarray], weight: np.ndarray | None = None) -> None:
        """Adagrad on the batches ``picks``; max pooling leaves one window a filter to update."""
        p = self.p
        voc = Vocabulary(p.bits)
        ids = []
        for s in range(0, len(texts), 250):
            flat, starts = voc.encode(pa.array(texts[s:s + 250], pa.binary()).cast(pa.string()), self.pad)
            ids += [x.copy() for x in np.split(flat, starts[1:])]
        feats = np.array(voc.feats or [(0, 0, 0)], np.int32)
        del voc
        g_emb, g_conv, g_bias, g_out = self.g_emb, self.g_conv, self.g_bias, self.g_out
        for pick in picks:
            flat = np.concatenate([ids[i] for i in pick])
            starts = np.concatenate([[0], np.cumsum([len(ids[i]) for i in pick])[:-1]])
            seen, local = np.unique(flat, return_inverse=True)
            vec = np.zeros((len(seen), p.dim), np.float32)
            real = seen > 0
            f = feats[seen[real] - 1]
            vec[real] = self.emb[f].sum(1)
            ends = np.append(starts[1:], len(flat)) - self.pad + 1
            pool, where = [], []
            for c in self.maps(vec, local):
                w = np.stack([c[s:e].argmax(0) + s for s, e in zip(starts, ends)])
                where.append(w)
                pool.append(c[w, np.arange(p.filters)])
            pre = np.stack(pool, 1) + self.bias
            m = np.maximum(pre, 0)
            z = (m * self.out).sum((1, 2)) + self.const
            err = (1 / (1 + np.exp(-z)) - (toxic[pick] == 1)).astype(np.float32) / p.batch
            if weight is not None:
                err *= weight[pick]
            d_out = (err[:, None, None] * m).sum(0)
            d_pre = err[:, None, None] * self.out * (pre > 0)
            d_vec = np.zeros_like(vec)
            for i, w in enumerate(p.widths):
                d = d_pre[:, i]
                for j in range(w):
                    rows = local[where[i] + j]
                    d_k = np.einsum("bfd,bf->df", vec[rows], d)
                    np.add.at(d_vec, rows.ravel(), (d[..., None] * self.conv[i][j].T[None]).reshape(-1, p.dim))
                    g_conv[i][j] += d_k ** 2
                    self.conv[i][j] -= p.rate * d_k / np.sqrt(g_conv[i][j])
            d_bias = d_pre.sum(0)
            g_bias += d_bias ** 2
            self.bias -= p.rate * d_bias / np.sqrt(g_bias)
            g_out += d_out ** 2
            self.out -= p.rate * d_out / np.sqrt(g_out)
            self.const -= np.float32(p.rate * err.sum())
            touched = np.flatnonzero(real & d_vec.any(1))
            rows, grads = feats[seen[touched] - 1], d_vec[touched]
            g_rows = np.unique(rows.ravel())
            total = np.zeros((len(g_rows), p.dim), np.float32)
            np.add.at(total, np.searchsorted(g_rows, rows.ravel()), np.repeat(grads, 3, axis=0))
            g_emb[g_rows] += (total ** 2).mean(1)
            self.emb[g_rows] -= p.rate * total / np.sqrt(g_emb[g_rows])[:, None]

    def calibrate(self, z: np.ndarray, group: np.ndarray, toxic: np.ndarray, rows: np.ndarray | None = None) -> None:
        """A threshold for each language group: the middle of the widest gap among those with the best F1.
        ``rows``: how many rows each entry stands for, ``toxic`` of them toxic (none: one each)."""
        rows = np.ones(len(z), np.int64) if rows is None else rows
        every = _best_threshold(z, toxic, rows)
        at = np.log(self.p.cutoff / (1 - self.p.cutoff))
        for g in range(len(GROUPS)):
            own = group == g
            enough = rows[own].sum() >= 40 and toxic[own].sum() >= 8
            self.shift[g] = at - (_best_threshold(z[own], toxic[own], rows[own]) if enough else every)


def _best_threshold(z: np.ndarray, toxic: np.ndarray, rows: np.ndarray) -> float:
    order = np.argsort(-z, kind="stable")
    z, hit = z[order], np.cumsum(toxic[order])
    f1 = 2 * hit / (np.cumsum(rows[order]) + hit[-1])
    gap = np.append(z[:-1] - z[1:], 0.5)
    f1[gap <= 0] = 0
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    i = best[gap[best].argmax()]
    return float(z[i] - gap[i] / 2)


def _groups(voc: Vocabulary, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    group = np.array([-1, *voc.group], np.int8)[ids]
    hit = np.flatnonzero(group >= 0)
    doc = np.searchsorted(starts, hit, side="right") - 1
    n = np.zeros((len(starts), len(GROUPS)), np.int64)
    np.add.at(n, (doc, group[hit]), 1)
    n[:, -1] = (n[:, :-1].max(1) == 0)
    return n.argmax(1)


def train(docs: DataFrame, labels: DataFrame, p: Params | None = None) -> ConvNet:
    """Fit on every labelled row of ``docs(doc_id, text)``, one text (the least) an id.
    ``labels(doc_id, toxic)`` must already be restricted to the rows that may be learnt from.

    The first fit sees at most ``p.sample`` of them: the rows with the least hash of the id
    in each class. Where there are more, :func:`_learn_all` goes on with all of them."""
    p = p or Params()
    one = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    yes, no = p.sample * 2 // 5, p.sample * 3 // 5
    pick = one.filter("toxic = 1").orderBy(*order).limit(yes).unionByName(one.filter("toxic = 0").orderBy(*order).limit(no))
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))

    def joined(texts: DataFrame, ids: DataFrame) -> DataFrame:
        return texts.join(ids, "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))

    rows = joined(texts, F.broadcast(pick)).toPandas().sort_values(["doc_id", "toxic"])  # p.sample ids at most
    net = ConvNet(p)
    body, toxic = [bytes(t or b"") for t in rows["text"]], rows["toxic"].to_numpy(np.int64)
    rows = rows.drop(columns="text")
    n = one.agg(F.count_if(F.expr("toxic = 1")).alias("yes"), F.count_if(F.expr("toxic = 0")).alias("no")).first()
    more = n.yes > yes or n.no > no
    if len(set(toxic)) == 2:
        hold = np.array([zlib.crc32(b"%d" % i) % 5 == 0 for i in rows["doc_id"]])
        if toxic[hold].sum() < 40:
            hold[:] = False  # too few to set some aside: calibrate on the fitted rows
        keep = np.flatnonzero(~hold)
        net.fit([body[i] for i in keep], toxic[keep])
        trim()
        if not more:
            use = np.flatnonzero(hold) if hold.any() else keep
            z, g = [], []
            for s in range(0, len(use), 256):
                a, b = net_scores(net, Vocabulary(p.bits), pa.array([body[i] for i in use[s:s + 256]], pa.binary()).cast(pa.string()))
                z.append(a)
                g.append(b)
            net.calibrate(np.concatenate(z), np.concatenate(g), toxic[use])
    elif not more:
        net.out[:], net.const = 0, np.float32(-np.inf)
    del body, rows
    trim()
    if more:
        # texts are moved once: join, grouping and shares have the same partitions
        tasks = 1 + (n.yes + n.no) // p.share
        _learn_all(net, joined(texts.repartition(tasks, "doc_id"), one.filter("toxic in (0, 1)").repartition(tasks, "doc_id")))
    return net


#: Learnt changes are added up, and scores counted, in steps of these parts of one: exact in any order.
_STEP, _FINE = 1 << 32, 1 << 10


def _learn_all(net: ConvNet, rows: DataFrame) -> None:
    """Learn from every row of ``rows(doc_id, toxic, text)``, from ``net`` on: each task its
    partition, in the order of a hash; the net then moves by the mean change of the tasks that
    changed a number. A fifth of the rows is set aside for the thresholds (none, if
    that holds under 40 toxic ones)."""
    p, sc = net.p, rows.sparkSession.sparkContext
    aside = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    dealt = materialize(rows.withColumn("aside", aside).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id"))
    n = dealt.agg(*[F.count_if(F.expr(f"{a}toxic = {c}")).alias(f"{k}{c}") for k, a in (("all", ""), ("aside", "aside and ")) for c in (0, 1)]).first()
    if not (n.all0 and n.all1):
        net.out[:], net.const = 0, np.float32(-np.inf)
        return
    hold = n.aside1 >= 40
    learnt = (n.all0 - n.aside0, n.all1 - n.aside1) if hold else (n.all0, n.all1)
    heavy = np.array([sum(learnt) / (2 * max(x, 1)) for x in learnt], np.float32)
    model = sc.broadcast(net)  # of fixed size

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, before = copy.deepcopy(model.value), model.value.state()
        for b in batches:
            for s in byte_slices(b.column("text"), 4_000_000):
                texts, toxic = b.column("text")[s].to_pylist(), b.column("toxic")[s].to_numpy().astype(np.int64)
                picks = np.array_split(np.arange(len(toxic)), -(-len(toxic) // p.batch)) * p.passes
                own.learn([t or b"" for t in texts], toxic, picks, heavy[toxic])
        change = np.rint((own.state().astype(np.float64) - before) * _STEP).astype(np.int64)
        at = np.flatnonzero(change.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(c) for c in change[at].T)], names=["at", *names])

    names = [f"v{i}" for i in range(p.dim)]
    fitted = dealt.where("not aside") if hold else dealt
    moved = fitted.select("toxic", "text").mapInArrow(lean(learn), ", ".join(f"{c} long" for c in ("at", *names)))
    mean = moved.groupBy("at").agg(*[(F.sum(c) / F.count("*")).alias(c) for c in names]).toPandas()  # of the net's size
    model.unpersist()
    net.add(mean["at"].to_numpy(), mean[names].to_numpy() / _STEP)
    del mean
    trim()
    model = sc.broadcast(net)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for b in batches:
            for s in byte_slices(b.column("text"), 2_000_000):
                z, g = net_scores(own, Vocabulary(p.bits), b.column("text")[s])
                fine = np.rint(np.clip(z.astype(np.float64), -50, 50) * _FINE).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(fine), pa.array(g.astype(np.int64)), b.column("toxic")[s].cast(pa.int64())], names=["z", "g", "toxic"])

    held = dealt.where("aside") if hold else dealt
    seen = held.select("toxic", F.col("text").cast("string").alias("text")).mapInArrow(lean(scored), "z long, g long, toxic long")
    c = seen.groupBy("z", "g").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("rows")).toPandas()  # a row a step and group
    net.calibrate(c["z"].to_numpy() / _FINE, c["g"].to_numpy(), c["toxic"].to_numpy(), c["rows"].to_numpy())


def net_scores(net: ConvNet, voc: Vocabulary, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    ids, starts = voc.encode(texts, net.pad)
    seen, local = np.unique(ids, return_inverse=True)
    feats = np.array(voc.feats, np.int64).reshape(-1, 3)[seen[seen > 0] - 1]
    vec = net.vectors(feats)
    if not (len(seen) and seen[0] == 0):
        vec = vec[1:]
    return net.logits(vec, local, starts), _groups(voc, ids, starts)


def score(docs: DataFrame, net: ConvNet, id_col: str = "doc_id", text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """``id_col``, the columns of ``keep`` and ``score`` for every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(net)  # of fixed size
    cols = [id_col, *(keep or [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        voc = Vocabulary(net.p.bits)
        for b in batches:
            for s in byte_slices(b.column("_raw"), 2_000_000):
                own = b.slice(s.start, s.stop - s.start)
                if len(voc.rows) > net.p.cache:
                    voc = Vocabulary(net.p.bits)
                z, g = net_scores(net, voc, own.column("_raw"))
                p = 1 / (1 + np.exp(-(z.astype(np.float64) + net.shift[g])))
                yield pa.RecordBatch.from_arrays([*(own.column(i) for i in range(len(cols))), pa.array(p)], names=[*cols, "score"])

    schema = docs.select(*cols, F.lit(0.0).alias("score")).schema
    return docs.select(*cols, F.col(text_col).alias("_raw")).mapInArrow(lean(run), schema)
