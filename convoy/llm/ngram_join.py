"""Exact n-gram Jaccard join with PartEnum signatures.

A text's set holds its distinct ``n``-word shingles. Two sets link when
``100 * intersection >= percent * union``. After Arasu, Ganti and Kaushik
("Efficient Exact Set-Similarity Joins", 2006):

* Sizes are cut into bands. A pair whose smaller set lies in band ``i`` has its
  larger one in band ``i`` or ``i + 1`` and differs in at most ``k_i`` elements.
* For band ``i`` the feature domain is hashed into ``k_i + 1 + m`` partitions.
  At least ``m + 1`` of them hold the same elements in both sets, so the sets
  share the signature of such a partition (of all subsets of partitions the
  ones of a single partition are enumerated). Partitions of few elements say little
  (one common shingle alone would join all its sets), empty ones nothing: a set
  leaves out those of up to ``t`` elements, ``t`` the most that leaves out ``m``
  partitions or fewer. No link is lost: of two linked sets, take the one of the greater
  ``t``; one of the ``m + 1`` equal partitions has more elements, so both emit it.
* Equal sets collapse to one node first (minimum per set fingerprint, combined
  on the map side). Nodes that share a signature are candidates if histograms of
  their elements (which bound the difference from below, so no link is lost) allow a
  link; nodes that only share a signature connect nothing. They are compared with
  the first ones of the signature, and then those that this left in different
  groups with each other. Each connected group forms blocks, and in each pair of
  blocks all intersections are counted exactly.

The result has a row for each input row: its class is the least ``doc_id``
reachable by links, its group the ``root`` (the least node), which tells classes
without an id apart. Sets are compared by 64-bit shingle hashes, nodes by a
64-bit fingerprint of the whole set.

Defined results: A-Z are lower-cased; with fewer than ``n`` words the whole
sequence is the only shingle; NULL, empty or blank texts have size 0, link with
nothing and are their own class; repeated rows link with each other; a NULL id
takes part but names no class; other columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import batch_bytes, byte_slices, cut, lean, pack, parts, release, scratch, sorted_groups, split_words, unpack
from convoy.llm.components import connected_components
from convoy.sources.sinks import remove

MIX1, MIX2, STEP = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
S33 = np.uint64(33)
#: Sets whose intersections are counted at a time, and their shingles.
BLOCK, STEP_SHINGLES = 1024, 250_000
#: Nodes of a block whose texts go to one task, and their shingles (a text travels once for
#: each block of its group), and bytes of compressed texts that come at a time.
TEXT_BLOCK, BLOCK_SHINGLES, BATCH_BYTES = 4096, 2_000_000, 2 << 20
#: Nodes of a block that are compared by histograms alone.
CELL_BLOCK = 8192
#: Nodes at the head of a signature that the others are compared with first.
LEADS = 6
#: Sets of a block that hold an element counted by a matrix product, columns of a
#: product, and counts along sets that are held at a time.
OFTEN, COLUMNS, STRETCH = 48, 2048, 2_000_000
#: Cells of the histogram that tells sets apart before their texts are fetched.
CELL_BITS = 6
#: Signatures that one group should receive.
SHARD_SIGNATURES, LEAST_SHARDS = 2_000_000, 8


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    h = (h ^ (h >> S33)) * MIX1
    h = (h ^ (h >> S33)) * MIX2
    return h ^ (h >> S33)


class Bands:
    """Size bands and, for each, the greatest difference ``k`` and the slack ``m``."""

    def __init__(self, percent: int = 85, width: float = 1.3, largest: int = 1 << 40):
        self.percent, self.low = percent, [1]
        while self.low[-1] <= largest:
            a = self.low[-1]
            self.low.append(max(100 * a // percent + 1, int(a * width)))
        self.k, self.m = [], []
        for i in range(len(self.low) - 1):
            top = self.low[i + 1] - 1
            k = (100 - percent) * (top + 100 * top // percent) // (100 + percent)
            self.k.append(k)
            self.m.append(-(-15 * (k + 1) // 100) + 1 if k else 0)

    def of(self, size: int) -> list[int]:
        """Bands that a set of this size emits signatures for."""
        i = bisect.bisect_right(self.low, size) - 1
        own = [i]
        if i and -(-self.percent * size // 100) < self.low[i]:
            own.append(i - 1)
        return [b for b in own if self.k[b]]  # without a difference only equal sets link


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    uniq, codes, count = split_words(texts)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in uniq], np.uint64)[codes] if uniq else np.zeros(0, np.uint64)
    stop = np.cumsum(count)
    whole = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for j in range(n):
        whole = whole * STEP + h[j:j + len(whole)]
    whole = mix(whole + np.uint64(n))
    out = []
    for a, b in zip(stop - count, stop):
        if b - a >= n:
            out.append(np.unique(whole[a:b - n + 1]))
        elif b > a:
            s = np.zeros(1, np.uint64)
            for x in h[a:b]:
                s = s * STEP + x
            out.append(mix(s + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(s: np.ndarray) -> int:
    return int(mix(np.array([mix(s).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def histogram(s: np.ndarray) -> bytes:
    """How many elements fall into each of CELLS cells of the domain: two sets
    differ in at least the sum of the differences of the counts. A count takes as
    few bytes as the greatest one needs."""
    n = np.bincount((mix(s + MIX1) >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=1 << CELL_BITS)
    return n.astype("<u1" if n.max() < 1 << 8 else "<u2" if n.max() < 1 << 16 else "<u4").tobytes()


def histograms(raw: list[bytes]) -> np.ndarray:
    """The counts of ``histogram``, a row for each of ``raw``."""
    cells = 1 << CELL_BITS
    width = np.array([len(x) for x in raw]) // cells
    out = np.empty((len(raw), cells), np.int32)
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        out[own] = np.frombuffer(b"".join(raw[i] for i in own), f"<u{w}").reshape(len(own), cells)
    return out


def signatures(sets: list[np.ndarray], bands: Bands) -> list[np.ndarray]:
    """PartEnum signatures (int64) of every set; all partitions of all sets in one sweep."""
    jobs = [(d, b) for d, s in enumerate(sets) if len(s) for b in bands.of(len(s))]
    if not jobs:
        return [np.zeros(0, np.int64)] * len(sets)
    size = np.array([len(sets[d]) for d, _ in jobs])
    n1 = np.array([bands.k[b] + 1 + bands.m[b] for _, b in jobs], np.int64)
    band = np.array([b for _, b in jobs], np.uint64)
    el = np.concatenate([sets[d] for d, _ in jobs])
    job = np.repeat(np.arange(len(jobs)), size)
    first = np.cumsum(n1) - n1
    part = ((mix(el ^ STEP) >> np.uint64(32)) * n1[job].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    cell = first[job] + part
    order = np.argsort(cell, kind="stable")
    cell, value = cell[order], mix(el + STEP)[order]
    at = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    sums, held, cell = np.add.reduceat(value, at), np.diff(np.r_[at, len(cell)]), cell[at]
    owner = np.searchsorted(first, cell, side="right") - 1
    tag = lambda o, c: mix(band[o] << np.uint64(40) | (c - first[o]).astype(np.uint64))
    sig = mix(sums + tag(owner, cell)).view(np.int64)
    filled = np.bincount(owner, minlength=len(jobs))
    empty = n1 - filled
    # partitions of the same set with at most as many elements as each
    order = np.lexsort((held, owner))
    last = np.flatnonzero(np.r_[(owner[order][1:] != owner[order][:-1]) | (held[order][1:] != held[order][:-1]), True])
    upto = last[np.searchsorted(last, np.arange(len(order)))] + 1 - (np.cumsum(filled) - filled)[owner[order]]
    light = np.empty(len(order), np.int64)
    light[order] = upto + empty[owner[order]]
    emit = light > np.array([bands.m[b] for _, b in jobs])[owner]
    out: list[list[np.ndarray]] = [[] for _ in sets]
    cuts = np.searchsorted(owner, np.arange(1, len(jobs)))
    for j, (s, some) in enumerate(zip(np.split(sig, cuts), np.split(emit, cuts))):
        d, b = jobs[j]
        out[d].append(s[some])
        if empty[j] > bands.m[b]:
            rest = np.setdiff1d(np.arange(first[j], first[j] + n1[j]), cell[owner == j])
            out[d].append(mix(tag(np.full(len(rest), j), rest)).view(np.int64))
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]


def features(docs: DataFrame, n: int, bands: Bands) -> DataFrame:
    """``doc_id, text_hash, n_shingles, key, cells, sigs`` of every row. Of equal sets
    that one task meets, the first alone carries its signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for s in byte_slices(b.column("text"), 2_000_000):
                own = b.slice(s.start, s.stop - s.start)
                sets = shingle_sets(own.column("text"), n)
                keys = [fingerprint(x) if len(x) else None for x in sets]
                emit = []
                for k, x in zip(keys, sets):
                    emit.append(x if k is not None and k not in seen else x[:0])
                    seen.add(k)
                if len(seen) > 200_000:
                    seen.clear()
                sigs = signatures(emit, bands)
                yield pa.RecordBatch.from_arrays([
                    own.column("doc_id"), own.column("text_hash"), pa.array([len(x) for x in sets], pa.int64()), pa.array(keys, pa.int64()), pa.array([histogram(x) for x in sets], pa.binary()),
                    pa.ListArray.from_arrays(np.cumsum([0, *map(len, sigs)]).astype(np.int32), np.concatenate(sigs) if sigs else np.zeros(0, np.int64))],
                    names=["doc_id", "text_hash", "n_shingles", "key", "cells", "sigs"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(lean(run), "doc_id long, text_hash long, n_shingles long, key long, cells binary, sigs array<long>")


def _deal(shards: int):
    """``(sigs, key)`` rows as packed blocks ``(shard, n, body)``: of a signature
    the shard takes some bits, and 40 more travel. Two that fall together by
    chance only make a candidate more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("sigs")
            sig = lists.flatten().to_numpy().view(np.uint64)
            key = np.repeat(b.column("key").to_numpy(), np.diff(lists.offsets.to_numpy()))
            if not len(sig):
                continue
            shard = (sig >> np.uint64(40)) % np.uint64(shards)
            order = np.lexsort((sig & np.uint64(0xFF_FFFF_FFFF), shard))
            sig, key, shard = sig[order], key[order], shard[order]
            cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
            rows = []
            for i in range(shards):
                k = slice(cuts[i], cuts[i + 1])
                if cuts[i + 1] > cuts[i]:
                    low = (sig[k] >> np.uint64(32) & np.uint64(255)).astype(np.uint8), sig[k].astype(np.uint32)
                    rows.append((i, len(key[k]), pack(*low, key[k])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), pa.int32(), pa.binary()])], names=["shard", "n", "body"])

    return run


def _shared(key: tuple, table: pa.Table) -> pa.Table:
    """In a shard, the nodes of each signature that several have: ``met`` stands for
    these nodes, so signatures of the same nodes count once."""
    got = [unpack(z, n, ["u1", "<u4", "<i8"]) for n, z in zip(table.column("n").to_pylist(), table.column("body").to_pylist())]
    high, low, node = (np.concatenate(c) for c in zip(*got))
    sig = high.astype(np.uint64) << np.uint64(32) | low
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    own = np.r_[True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])]
    sig, node = sig[own], node[own]
    at = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
    size = np.diff(np.r_[at, len(sig)])
    met, some = np.add.reduceat(mix(node.view(np.uint64)), at), np.flatnonzero(size > 1)
    some = some[np.unique(met[some], return_index=True)[1]]
    rows = np.repeat(at[some] - np.cumsum(size[some]) + size[some], size[some]) + np.arange(size[some].sum())
    return pa.table({"met": np.repeat(met[some], size[some]).view(np.int64), "node": node[rows]})


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of two blocks: elements of many sets are
    counted by a matrix product, the others along the sets that hold them."""
    n1, n2 = len(left), len(right)
    size = np.array([len(x) for x in (*left, *right)])
    stop = np.cumsum(size)
    el, inv = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    of, cut_ = np.repeat(np.arange(n1 + n2), size), stop[n1 - 1]
    x, y = (np.bincount(part, minlength=len(el)) for part in (inv[:cut_], inv[cut_:]))
    both = np.zeros((n1, n2), np.int64)

    column, often = np.full(len(el), -1), np.flatnonzero((x > 0) & (y >= OFTEN))
    column[often] = np.arange(len(often))
    of_column = column[inv]
    for c in range(0, len(often), COLUMNS):
        held = np.zeros((n1 + n2, min(COLUMNS, len(often) - c)), np.float32)
        hit = (of_column >= c) & (of_column < c + COLUMNS)
        held[of[hit], of_column[hit] - c] = 1
        both += (held[:n1] @ held[n1:].T).astype(np.int64)

    # where the sets of ``right`` that hold each of the other elements begin
    rare = cut_ + np.flatnonzero(((x > 0) & (y < OFTEN))[inv[cut_:]])
    rare = rare[np.argsort(inv[rare], kind="stable")]
    start, holder = np.searchsorted(inv[rare], np.arange(len(el) + 1)), of[rare] - n1
    lo, n = start[inv[:cut_]], np.diff(start)[inv[:cut_]]
    work = np.r_[0, np.cumsum(n)][np.r_[0, stop[:n1]]]
    s = 0
    while s < n1:
        e = max(s + 1, int(np.searchsorted(work, work[s] + STRETCH, side="right")) - 1)
        k = slice(stop[s] - size[s], stop[e - 1])
        at = np.repeat(lo[k] - np.cumsum(n[k]) + n[k], n[k]) + np.arange(n[k].sum())
        both[s:e] += np.bincount(np.repeat(of[k] - s, n[k]) * n2 + holder[at], minlength=(e - s) * n2).reshape(e - s, n2)
        s = e
    return both


def linked(small: list[np.ndarray], large: list[np.ndarray], percent: int, same: bool) -> Iterator[tuple[int, np.ndarray]]:
    """For each set of ``small`` the positions in ``large`` that it links with
    (``same``: the lists are one and only later positions count)."""
    size = np.array([len(x) for x in large])
    for i, both in enumerate(common(small, large)):
        hit = np.flatnonzero(100 * both >= percent * (len(small[i]) + size - both))
        hit = hit[hit > i] if same else hit
        if len(hit):
            yield i, hit


def _apart(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether histograms rule a link out, row by row."""
    far = np.abs(x - y).sum(-1, dtype=np.int64)
    return far * (100 + percent) > (100 - percent) * (x.sum(-1, dtype=np.int64) + y.sum(-1, dtype=np.int64))


def _first_plausible(percent: int):
    """Rows ``(met, node, cells)`` in order: edges from the first nodes that share a
    signature to those whose histograms don't rule a link out. Only a start, in one
    sweep: ``_plausible`` compares what this leaves apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            raw = b.column("cells").to_pylist()
            cols = [b.column("met").to_numpy(), b.column("node").to_numpy(), histograms(raw)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            met, node, cells = cols
            left, leads, out = np.arange(len(met)), [], []
            for _ in range(LEADS):
                m = met[left]
                new = np.r_[True, m[1:] != m[:-1]]
                lead = left[np.maximum.accumulate(np.where(new, np.arange(len(m)), 0))]
                leads.append(left[new][met[left[new]] == met[-1]])
                near = ~_apart(cells[lead], cells[left], percent)
                hit = near & (lead != left)
                out.append((node[lead[hit]], node[left[hit]]))
                left = left[~near]
                if not len(left):
                    break
            held = [x[np.sort(np.concatenate(leads))] for x in cols]  # the last group may go on
            a, c = (np.concatenate(x) for x in zip(*out))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], names=["a", "b"])

    return run


def _plausible(percent: int):
    """Within a pair of blocks, edges that connect all sets of different ``comp`` whose
    histograms don't rule a link out."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in sorted_groups(batches, ["met", "i", "j"]):
            cells = histograms(g["cells"].tolist())
            node, block, size = g["node"].to_numpy(), g["block"].to_numpy(), cells.sum(1, dtype=np.int64)
            left, right = np.flatnonzero(block == g["i"].iloc[0]), np.flatnonzero(block == g["j"].iloc[0])
            label, out = np.unique(g["comp"], return_inverse=True)[1], []
            for x in left:
                ys = right[right > x] if g["i"].iloc[0] == g["j"].iloc[0] else right
                ys = ys[label[ys] != label[x]]
                if not len(ys):
                    continue
                apart = np.abs(cells[ys] - cells[x]).sum(1, dtype=np.int64)
                ys = ys[apart * (100 + percent) <= (100 - percent) * (size[ys] + size[x])]
                other, first = np.unique(label[ys], return_index=True)
                for o, y in zip(other, ys[first]):
                    out.append((node[x], node[y]))
                    label[label == o] = label[x]
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    return run


def _steps(at: np.ndarray, size: np.ndarray, step: int, room: int) -> list[np.ndarray]:
    """``at`` in runs of up to ``step`` sets and ``room`` elements (a larger set alone)."""
    total, cuts = np.cumsum(size[at]), [0]
    while cuts[-1] < len(at):
        s = cuts[-1]
        full = int(np.searchsorted(total, (total[s - 1] if s else 0) + room, side="right"))
        cuts.append(max(s + 1, min(full, s + step, len(at))))
    return [at[x:y] for x, y in zip(cuts, cuts[1:])]


def _verify(n: int, percent: int, step: int, room: int):
    """Links of all nodes within a pair of blocks, runs of ``_steps`` at a time: a forest of
    them, and counts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in sorted_groups(_with_shingles(batches, n), ["root", "i", "j"]):
            sets = g["shingles"].tolist()
            node, copies, block = g["node"].to_numpy(), g["copies"].to_numpy(), g["block"].to_numpy()
            i, j = g["i"].iloc[0], g["j"].iloc[0]
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            if not len(left) or not len(right):
                continue
            links, label, forest = np.zeros(len(g), np.int64), np.arange(len(g)), []
            size = np.array([len(x) for x in sets])
            lefts, rights = (_steps(at, size, step, room) for at in (left, right))
            for a, some in enumerate(lefts):
                for b, others in enumerate(rights[a:], a) if i == j else enumerate(rights):
                    for x, ys in linked([sets[k] for k in some], [sets[k] for k in others], percent, i == j and a == b):
                        x, ys = some[x], others[ys]
                        links[x] += copies[ys].sum()
                        links[ys] += copies[x]
                        other, first = np.unique(label[ys], return_index=True)
                        for o, k in zip(other, ys[first]):
                            if label[x] != o:
                                forest.append((node[x], node[k], 0))
                                label[label == o] = label[x]
            got = np.flatnonzero(links)
            rows = forest + [(node[k], node[k], links[k]) for k in got]
            if rows:
                yield pd.DataFrame(rows, columns=["a", "b", "links"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the candidates, compressed, once for each pair of blocks they take part
    in (a text is far smaller than its shingle hashes, which don't compress)."""
    import zstandard as zstd

    press = zstd.ZstdCompressor(level=1)
    names = ["root", "i", "j", "block", "node", "copies", "body"]
    kinds = [pa.int64()] * 6 + [pa.binary()]
    for b in batches:
        for s in byte_slices(b.column("text"), 2_000_000):
            own = b.slice(s.start, s.stop - s.start)
            cols = [own.column(c).to_pylist() for c in ("root", "node", "blocks", "copies")]
            out = []
            for root, node, nb, copies, text in zip(*cols, own.column("text").cast(pa.binary()).to_pylist()):
                block, body = node % nb, press.compress(text)
                out += [(root, min(block, o), max(block, o), block, node, copies, body) for o in range(nb)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)


def _with_shingles(batches: Iterator[pd.DataFrame], n: int) -> Iterator[pd.DataFrame]:
    """Rows of ``_blocks`` with the shingle set in place of the text; a node's text is
    split once a batch. A text of another set (of an equal hash) goes."""
    import zstandard as zstd

    for b in batches:
        once = b.drop_duplicates("node")
        press = zstd.ZstdDecompressor()
        texts = pa.array([press.decompress(z) for z in once["body"]], pa.large_binary()).cast(pa.large_string(), safe=False)
        sets, at = {}, 0
        for s in byte_slices(texts, 2_000_000):
            for x in shingle_sets(texts.slice(s.start, s.stop - s.start), n):
                node = int(once["node"].iat[at])
                if fingerprint(x) == node:
                    sets[node] = x
                at += 1
        b = b.drop(columns="body").assign(shingles=[sets.get(k) for k in b["node"]])
        yield b[b["shingles"].notna()]


def _block_pairs(group: DataFrame) -> DataFrame:
    """Members of each group once for each pair of blocks they take part in: ``met, i, j, block, node, comp``."""
    size = group.groupBy("met").agg(F.ceil(F.count("*") / CELL_BLOCK).cast("long").alias("blocks"))
    rows = group.join(size, "met").withColumn("block", F.pmod("node", "blocks"))
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return rows.select("met", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "node", "comp")


def _candidates(shared: DataFrame, cells: DataFrame, percent: int, width: int) -> DataFrame:
    """Groups ``(node, root)`` of the nodes ``(met, node)`` that share a signature and whose
    histograms don't rule a link out: what only shares a signature connects nothing."""
    dealt = shared.join(cells, "node").select("met", "node", "cells").repartition(width, "met").sortWithinPartitions("met", "node")
    edges = cut(dealt.mapInArrow(lean(_first_plausible(percent)), "a long, b long").distinct())
    del dealt
    release(shared.sparkSession)
    comp = connected_components(edges).select("node", F.col("root").alias("comp"))
    placed = cut(shared.join(comp, "node", "left").select("met", "node", F.coalesce("comp", "node").alias("comp")))
    apart = placed.groupBy("met").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    rows = _block_pairs(placed.join(apart, "met", "left_semi")).join(cells, "node")
    rows = rows.repartition(width, "met", "i", "j").sortWithinPartitions("met", "i", "j", "node")
    return connected_components(edges.union(rows.mapInPandas(lean(_plausible(percent)), "a long, b long")))


def row_key(doc_id: Column, text_hash: Column) -> Column:
    """Key of all rows of the same id (or none) and text."""
    return F.xxhash64(doc_id, text_hash)


def _nodes(feats: DataFrame) -> DataFrame:
    """A row for each distinct set: ``key, copies, cells, size, rep, row`` (its least id, and the key of that row)."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    nodes = feats.filter("key is not null").groupBy("key").agg(
        F.min(first).alias("first"), F.count("*").alias("copies"), F.min("cells").alias("cells"), F.min("n_shingles").alias("size"))
    return nodes.withColumn("rep", F.col("first.doc_id")).withColumn("row", row_key(F.col("rep"), F.col("first.text_hash"))).drop("first")


def join(docs: DataFrame, n: int = 4, percent: int = 85, width: float = 1.3) -> DataFrame:
    """``doc_id, text_hash, n_shingles, key, component_id, n_links, root`` for each row
    of ``docs(doc_id, text)``; ``n_links`` counts the rows it links with."""
    spark, bands = docs.sparkSession, Bands(percent, width)
    path, width_ = scratch(spark, "ngram-join"), parts(docs)
    features(docs, n, bands).write.parquet(f"{path}/features")
    feats = spark.read.parquet(f"{path}/features")
    named = feats.filter("key is not null")
    total = named.agg(F.sum(F.size("sigs"))).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-total // SHARD_SIGNATURES))
    sigs = named.select("sigs", "key").mapInArrow(lean(_deal(shards)), "shard int, n int, body binary")
    sigs.groupBy("shard").applyInArrow(_shared, "met long, node long").distinct().write.parquet(f"{path}/shared")
    del sigs
    release(spark)
    # signatures are most of the features and not read again
    feats.drop("sigs").write.parquet(f"{path}/rows")
    feats = spark.read.schema(feats.drop("sigs").schema).parquet(f"{path}/rows")
    nodes = _nodes(feats)
    remove(spark, f"{path}/features")
    group = _candidates(spark.read.parquet(f"{path}/shared"), nodes.select(F.col("key").alias("node"), "cells"), percent, width_)
    group.write.parquet(f"{path}/plausible")
    del group
    release(spark)
    group = spark.read.parquet(f"{path}/plausible")
    grouped = group.join(nodes, group["node"] == nodes["key"]).select("root", "node", "copies", "row", "size")
    blocks = F.ceil(F.greatest(F.count("*") / TEXT_BLOCK, F.sum("size") / BLOCK_SHINGLES)).cast("long").alias("blocks")
    members = grouped.join(grouped.groupBy("root").agg(blocks), "root").drop("size")
    # one text for each node, also if its row is repeated or has no id
    texts = members.join(docs.select(row_key(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("row"), "text"), "row").dropDuplicates(["row"]).drop("row")
    one = texts.mapInArrow(lean(_blocks), "root long, i long, j long, block long, node long, copies long, body binary")
    one = one.repartition(width_, "root", "i", "j").sortWithinPartitions("root", "i", "j", "node")
    checked = one.mapInPandas(lean(_verify(n, percent, BLOCK, STEP_SHINGLES)), "a long, b long, links long")
    with batch_bytes(spark, BATCH_BYTES):
        checked.write.parquet(f"{path}/links")
    del checked, one, texts, members
    release(spark)
    links = spark.read.parquet(f"{path}/links")

    found = connected_components(links.filter("a <> b").select("a", "b"))
    low = found.join(nodes, found["node"] == nodes["key"]).groupBy("root").agg(F.min("rep").alias("component_id"))
    of = found.join(low, "root").select(F.col("node").alias("key"), "component_id", "root")
    count = links.filter("a = b").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    info = nodes.join(of, "key", "left").join(count, "key", "left").select(
        "key", F.coalesce("component_id", "rep").alias("component_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "key").alias("root"))
    return feats.drop("cells").join(info, "key", "left").select(
        "doc_id", "text_hash", "n_shingles", "key", F.coalesce("component_id", F.when(F.col("key").isNull(), F.col("doc_id"))).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), "root")
