"""Language identification as inference in a mixture of languages.

Each language is a smoothed multinomial over hashed byte n-grams, counted over
all training texts. A document is a mixture: expectation-maximisation estimates
the share of each language from its n-gram likelihoods. The set of languages is
selected by penalised likelihood: starting from the best single language, the
language whose addition raises the log-likelihood most joins as long as the gain
beats ``penalty * log(n-grams)``. The prediction is the language with the largest
share, the score that share's posterior weight against rival single languages.

Texts are prepared the same way for training and inference: A-Z lower-cased,
runs of ASCII that is no letter are one space, then n-grams of ``order`` bytes.

Defined results: NULL texts and texts without a letter (of any script) are
``und`` with score 0; without any training text every text is ``und``; texts too
short for an n-gram are padded by end marks; NULL training languages are ignored;
repeated rows are scored row by row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import byte_slices

#: A-Z to lower case, ASCII that is no letter to a space; 1 marks the ends of a text.
_PLAIN = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 or b == 1 else 32 for b in range(256)], np.uint8)
MUL = np.uint32(2654435761)


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray  # language x bucket, natural logarithm
    order: int
    bits: int
    penalty: float = 2.0
    rounds: int = 12


def grams(texts: list[bytes], order: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, text after text, and the number of each text's."""
    raw = [b"\1" + t + b"\1" * (order - 1) for t in texts]
    size = np.array([len(t) for t in raw], np.int64)
    b = _PLAIN[np.frombuffer(b"".join(raw), np.uint8)]
    doc = np.repeat(np.arange(len(raw)), size)
    keep = np.r_[True, (b[1:] != 32) | (b[:-1] != 32)] if len(b) else np.zeros(0, bool)
    b, doc = b[keep], doc[keep]
    h = np.zeros(max(0, len(b) - order + 1), np.uint32)
    for j in range(order):
        h = (h << np.uint32(8)) | b[j:j + len(h)] if order <= 4 else h * np.uint32(257) + b[j:j + len(h)]
    h = (h * MUL) >> np.uint32(32 - bits)
    same = doc[:len(h)] == doc[order - 1:]
    return h[same].astype(np.uint16 if bits <= 16 else np.uint32), np.bincount(doc[:len(h)][same], minlength=len(raw))


def _texts(a: pa.Array) -> list[bytes]:
    return [x or b"" for x in a.cast(pa.binary()).to_pylist()]


def train(docs: DataFrame, order: int = 4, bits: int = 16, smooth: float = 0.2) -> Model:
    """Count the n-grams of ``docs(text, lang)`` by language. Each task adds up
    its own counts; the sums (at most languages * 2^bits rows) are the model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs = np.array(b.column("lang").to_pylist(), object)
            for s in byte_slices(b.column("text"), 4_000_000):
                texts, own = _texts(b.column("text").slice(s.start, s.stop - s.start)), langs[s]
                for lang in set(own):
                    g, _ = grams([t for t, x in zip(texts, own) if x == lang], order, bits)
                    n = np.bincount(g, minlength=1 << bits)
                    sums[lang] = sums[lang] + n if lang in sums else n
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["lang", "g", "n"])

    rows = docs.filter("lang is not null and text is not null").select("lang", "text")
    sums = rows.mapInArrow(run, "lang string, g int, n long").groupBy("lang", "g").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sums["lang"].unique())
    n = np.zeros((len(langs), 1 << bits))
    n[[langs.index(x) for x in sums["lang"]] if len(sums) else [], sums["g"].to_numpy(np.int64)] = sums["n"]
    # shrink each language towards all of them together
    base = (n.sum(0) + 1) / (n.sum() + n.shape[1])
    logp = np.log((n + smooth * n.shape[1] * base) / (n.sum(1, keepdims=True) + smooth * n.shape[1])) if langs else n
    return Model(langs, logp.astype(np.float32), order, bits)


def shares(logp: np.ndarray, count: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """EM for the shares of the rows of ``logp`` and the log-likelihood reached."""
    top = logp.max(0)
    p, w = np.exp(logp - top), np.full(len(logp), 1 / len(logp))
    total = count.sum()
    for _ in range(rounds):
        mix = w @ p
        w = w * (p @ (count / mix)) / total
    return w, float(count @ (np.log(w @ p) + top))


def infer(m: Model, g: np.ndarray) -> tuple[int, float]:
    """The language with the largest share in the selected set, and its score."""
    u, count = np.unique(g, return_counts=True)  # of small integers: a radix sort
    logp, count = m.logp[:, u], count.astype(np.float64)
    alone = logp @ count
    best = int(alone.argmax())
    chosen, level, w = [best], float(alone[best]), np.ones(1)
    cost = m.penalty * np.log(max(len(g), 2))
    rivals = [i for i in range(len(m.langs)) if i != best]
    while rivals:
        # no mixture explains an n-gram better than its best member: a bound of the gain
        room = np.maximum(logp[rivals], logp[chosen].max(0)) @ count - level
        gain, join = cost, None
        for k in np.argsort(-room, kind="stable"):
            if room[k] <= gain:
                break
            w2, reach = shares(logp[chosen + [rivals[k]]], count, m.rounds)
            if reach - level > gain:
                gain, join = reach - level, (rivals[k], reach, w2)
        if join is None:
            break
        r, level, w = join
        chosen.append(r)
        rivals.remove(r)
    k = int(w.argmax())
    # the share, times the posterior of the language against those left out
    rest = np.delete(alone, chosen)
    odds = np.exp(np.clip(rest - alone[best], -700, 0)).sum() if len(rest) else 0.0
    return chosen[k], float(w[k] / (1 + odds))


def predict(docs: DataFrame, m: Model) -> DataFrame:
    """``doc_id, text``'s ``lang_pred`` and ``score`` for each row of ``docs``, next to ``doc_id``."""
    model = docs.sparkSession.sparkContext.broadcast(m)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            for s in byte_slices(b.column("text"), 4_000_000):
                own = b.slice(s.start, s.stop - s.start)
                texts = _texts(own.column("text"))
                g, n = grams(texts, m.order, m.bits)
                pred, score = ["und"] * len(texts), [0.0] * len(texts)
                for i, (t, x) in enumerate(zip(texts, np.split(g, np.cumsum(n)[:-1]))):
                    if m.langs and len(x) and any(map(str.isalpha, t.decode("utf-8", "replace"))):
                        k, score[i] = infer(m, x)
                        pred[i] = m.langs[k]
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
