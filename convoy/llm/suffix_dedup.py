"""Exact removal of repeated passages by a depth-limited suffix sort.

A byte goes if it is covered by a string of ``length`` bytes that also starts in
a document with a smaller ``doc_id``. Texts are UTF-8 bytes, matches stay within
a document, overlaps count, and strings are judged on the input.

The suffixes of all documents are ordered only through ``length`` bytes, by
most-significant-digit radix passes whose digits are eight bytes; groups that
are still together after the last pass are exactly the repeated windows. So that
not every suffix has to travel, the passes are prepared:

1. Every window of ``length`` bytes names its *anchor*, the ``Q``-byte string in
   it with the least hash. Equal windows name the same anchor at the same place,
   so a repeated window is only possible where an anchor occurs in two documents.
   Anchors (a few per hundred bytes) are dealt by hash, with a hash of all the
   bytes any window over them can hold.
2. Where those surroundings are equal too, all windows over the anchor repeat:
   the first radix group is settled at once. One such occurrence (of the least
   document) speaks for all others, per task and per group, so copies by the
   thousand don't meet.
3. Where an anchor has different surroundings, its suffixes - one for each window
   over it - are fetched and radix-sorted through ``length`` bytes. An anchor with
   more than ``HOT`` places is parted first: half of its windows hold the bytes
   after it, the others those before it, and these bytes join its key.

Positions go back to their texts in packed blobs, dealt by text, so that the rows
that Spark moves follow the bytes and not texts times shards.

A last pass over the texts unites the covered bytes. Equal whole texts are
settled by their digest before that.

Defined results: NULL is the empty text; texts shorter than ``length`` keep all
bytes; equal ids never remove each other; a NULL id is larger than any other;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import byte_slices, lean, pack, release, scratch, unpack
from convoy.llm.ngram_join import STEP, mix

Q = 16
#: Between texts; no byte of UTF-8.
GAP = 0xFF
#: Bytes of text whose anchors one group should receive.
SHARD_BYTES, LEAST_SHARDS = 32 << 20, 8
#: Places from which on an anchor is parted by its neighbouring bytes.
HOT = 4096
#: Marks such an anchor; shards and hashes stay below.
HOT_BIT = np.int64(1 << 62)
#: Copies of one text from which on it is looked up apart: a share of all rows.
HOT_SHARE = 1000
LAST = np.iinfo(np.int64).max


def _load(buf: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """The eight bytes from each position as one number."""
    x = np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))
    return x if at is None else x[at]


def layout(texts: list[bytes], gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with ``gap`` separators before, between and after; starts and ends."""
    size = np.array([len(t) for t in texts], np.int64)
    start = gap + np.cumsum(size + gap) - size - gap
    sep = bytes([GAP]) * gap
    return np.frombuffer(sep + sep.join(texts) + sep + b"\xff" * 8, np.uint8), start, start + size


def anchors(buf: np.ndarray, start: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of all windows, in order, and the text of each."""
    w = length - Q + 1
    x = _load(buf)
    h = (x[:-8] * STEP) ^ ((x[8:] + np.uint64(0x2545F4914F6CDD1D)) * np.uint64(0xFF51AFD7ED558CCD))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    # hash in the high half, position in the low half: the minimum names the leftmost place
    m = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    step, have = 1, 1
    while have * 2 <= w:
        m = np.minimum(m[:-step], m[step:])
        have, step = have * 2, step * 2
    if have < w:
        m = np.minimum(m[:-(w - have)], m[w - have:])
    ok = np.zeros(len(m) + 1, np.int8)
    long_ = end - start >= length
    np.add.at(ok, start[long_], 1)
    np.add.at(ok, end[long_] - length + 1, -1)
    at = (m[np.cumsum(ok[:-1], dtype=np.int8) > 0] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if len(at):
        at = at[np.r_[True, at[1:] != at[:-1]]]
    return at, np.searchsorted(start, at, side="right") - 1


KINDS = ["<u4", "<u8", "<i8", "<i8", "<u4"]  # anchor, surroundings, doc, row, position


def _first_of(keys: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys then doc, and for each row (in that order) its group's least doc."""
    order = np.lexsort((doc, *reversed(keys)))
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new |= np.r_[True, s[1:] != s[:-1]]
    d = doc[order]
    return order, d[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]


def _lists(n: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), pa.array(values))


BLOBS = "shard int, n int, body binary"
BLOB_SCHEMA = pa.schema([("shard", pa.int32()), ("n", pa.int32()), ("body", pa.binary())])


def _dealt(rid: np.ndarray, shards: int, *cols: np.ndarray) -> pa.Table:
    """One packed blob of ``rid`` and the other columns for each shard of texts."""
    shard = (mix(rid.view(np.uint64)) % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((rid, shard))
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    rows = []
    for i in np.flatnonzero(cuts[1:] > cuts[:-1]):
        k = order[cuts[i]:cuts[i + 1]]
        rows.append((int(i), len(k), pack(rid[k], *[c[k] for c in cols])))
    return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else ([], [], []), BLOB_SCHEMA)], schema=BLOB_SCHEMA)


def _opened(table: pa.Table, kinds: list[str]) -> list[np.ndarray]:
    """The columns of all packed blobs of a group."""
    n, body = table.column("n").to_pylist(), table.column("body").to_pylist()
    return [np.concatenate(c) for c in zip(*(unpack(z, k, kinds) for k, z in zip(n, body)))]


PLACES = ["<i8", "<u4", "<i8", "<u1"]  # row, position, anchor, settled


def _unite_places(table: pa.Table) -> pa.Table:
    """Rows ``(rid, full, open, anchor)``: a text's positions settled and open."""
    rid, pos, h, full = _opened(table, PLACES)
    order = np.lexsort((full, pos, rid))
    rid, pos, h, full = rid[order], pos[order], h[order], full[order] > 0
    # a place of a repeated row: once, settled if any says so
    last = np.r_[(rid[1:] != rid[:-1]) | (pos[1:] != pos[:-1]), True]
    rid, pos, h, full = rid[last], pos[last].astype(np.int32), h[last], full[last]
    cuts = np.flatnonzero(np.r_[True, rid[1:] != rid[:-1]])
    n_full = np.add.reduceat(full.astype(np.int64), cuts)
    n_open = np.diff(np.r_[cuts, len(rid)]) - n_full
    return pa.Table.from_arrays([pa.array(rid[cuts]), _lists(n_full, pos[full]), _lists(n_open, pos[~full]), _lists(n_open, h[~full])],
                                names=["rid", "full", "open", "anchor"])


def _unite_runs(table: pa.Table) -> pa.Table:
    """Rows ``(rid, lo, hi)``: a text's repeated runs."""
    rid, lo, hi = _opened(table, ["<i8", "<i4", "<i4"])
    order = np.lexsort((lo, rid))
    rid, lo, hi = rid[order], lo[order], hi[order]
    cuts = np.flatnonzero(np.r_[True, rid[1:] != rid[:-1]])
    n = np.diff(np.r_[cuts, len(rid)])
    return pa.Table.from_arrays([pa.array(rid[cuts]), _lists(n, lo), _lists(n, hi)], names=["rid", "lo", "hi"])


FOUND = "rid long, full array<int>, open array<int>, anchor array<long>"


def _anchor_blobs(length: int, shards: int):
    """``(shard, n, body)`` blobs; negative shards hold positions that an equal
    place in a smaller document of the same slice already settles."""
    pad = length - Q
    offs = [*range(-pad, length - 8, 8), length - 8]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in byte_slices(b.column("text"), 4_000_000):
                own = b.slice(s.start, s.stop - s.start)
                # of a repeated row, one speaks for all
                own = own.take(pa.array(np.sort(np.unique(own.column("rid").to_numpy(), return_index=True)[1])))
                texts = own.column("text").to_pylist()
                doc_of, rid_of = own.column("doc").to_numpy(), own.column("rid").to_numpy()
                buf, start, end = layout([t or b"" for t in texts], length)
                at, t = anchors(buf, start, end, length)
                if not len(at):
                    continue
                ctx = np.zeros(len(at), np.uint64)
                for o in offs:
                    ctx = (ctx ^ _load(buf, at + o)) * STEP
                    ctx ^= ctx >> np.uint64(31)
                ctx = mix(ctx)
                h = mix(_load(buf, at) * STEP + mix(_load(buf, at + 8)))
                doc, rid, pos = doc_of[t], rid_of[t], (at - start[t]).astype(np.uint32)
                shard = (h >> np.uint64(32)) % np.uint64(shards)
                h = h.astype(np.uint32)
                order, least = _first_of([ctx], doc)
                keep = np.zeros(len(at), bool)
                keep[order] = doc[order] == least
                rows = [(-1 - int(rid[~keep][0]) % shards, int((~keep).sum()), pack(rid[~keep], pos[~keep]))] if not keep.all() else []
                at = np.flatnonzero(keep)
                at = at[np.argsort(shard[at], kind="stable")]
                cuts = np.searchsorted(shard[at], np.arange(shards + 1, dtype=np.uint64))
                for i in range(shards):
                    k = at[cuts[i]:cuts[i + 1]]
                    if len(k):
                        rows.append((i, len(k), pack(h[k], ctx[k], doc[k], rid[k], pos[k])))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int32(), pa.int32(), pa.binary()])], names=["shard", "n", "body"])

    return run


def _match(shards: int, most: int):
    """Anchors of one shard: settled positions, and open ones of anchors with several
    surroundings, as blobs dealt by text."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        if shard < 0:
            rid, pos = _opened(table, ["<i8", "<u4"])
            return _dealt(rid, shards, pos, np.zeros(len(rid), np.int64), np.ones(len(rid), np.uint8))
        h, ctx, doc, rid, pos = _opened(table, KINDS)
        order, least = _first_of([h, ctx], doc)
        h, ctx, doc, rid, pos = h[order], ctx[order], doc[order], rid[order], pos[order]
        full = doc > least
        new = np.r_[True, h[1:] != h[:-1]]
        cuts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        mixed = (ctx[cuts] != ctx[np.r_[cuts[1:], len(h)] - 1]) & (np.minimum.reduceat(doc, cuts) != np.maximum.reduceat(doc, cuts))
        anchor = h.astype(np.int64) + (np.int64(shard) << np.int64(32))
        anchor[(np.diff(np.r_[cuts, len(h)]) > most)[group]] |= HOT_BIT
        want = full | mixed[group]
        return _dealt(rid[want], shards, pos[want], np.where(full, 0, anchor)[want], full[want].astype(np.uint8))

    return run


def _beside(buf: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of the ``n`` bytes from each position, and whether all belong to the text."""
    h, whole = np.zeros(len(at), np.uint64), np.ones(len(at), bool)
    for i in range(n):
        x = buf[at + i]
        h = (h ^ x) * STEP
        h ^= h >> np.uint64(31)
        whole &= x != GAP
    return h, whole


def _parted(buf: np.ndarray, at: np.ndarray, anchor: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, side, key)``: what each open place is sorted under. A place of a hot
    anchor comes twice, with the ``after`` bytes that windows of its first half hold
    (side 1) and with the bytes that the other windows hold before it (side 2)."""
    after = (pad + 1) // 2
    key = mix(anchor.view(np.uint64))
    hot = (anchor & HOT_BIT) > 0
    parts = [(np.flatnonzero(~hot), 0, key[~hot])]
    rows = np.flatnonzero(hot)
    for side, start, n in ((1, at[rows] + Q, after), (2, at[rows] - (pad - after + 1), pad - after + 1)):
        h, whole = _beside(buf, start, n)
        parts.append((rows[whole], side, mix(key[rows[whole]] ^ mix(h[whole] + np.uint64(side)))))
    row, key = (np.concatenate([p[i] for p in parts]) for i in (0, 2))
    return row, np.repeat([p[1] for p in parts], [len(p[0]) for p in parts]), key


def _suffix_blobs(length: int, shards: int):
    """The surroundings of open positions, dealt by anchor: ``(shard, n, body)``."""
    pad = length - Q
    span, after = np.arange(-pad, length), (pad + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in byte_slices(b.column("text"), 4_000_000):
                own = b.slice(s.start, s.stop - s.start)
                buf, start, _ = layout([t or b"" for t in own.column("text").to_pylist()], length)
                lists = own.column("open").to_pylist(), own.column("anchor").to_pylist()
                n = np.array([len(x) for x in lists[0]], np.int64)
                pos = np.array([p for x in lists[0] for p in x], np.int64)
                h = np.array([p for x in lists[1] for p in x], np.int64)
                if not len(pos):
                    continue
                doc, rid = (np.repeat(own.column(c).to_numpy(), n) for c in ("doc", "rid"))
                at = np.repeat(start, n) + pos
                row, side, key = _parted(buf, at, h, pad)
                h, at, doc, rid, pos = key.view(np.int64), at[row], doc[row], rid[row], pos[row]
                # anchors are dealt anew, evenly: a shard has few open ones
                shard = (mix(key) >> np.uint64(32)) % np.uint64(shards)
                order = np.argsort(shard, kind="stable")
                cuts = np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64))
                rows = []
                for i in range(shards):
                    k = order[cuts[i]:cuts[i + 1]]
                    if len(k):
                        raw = buf[at[k][:, None] + span]
                        # what the windows of the other side begin or end with
                        raw[side[k] == 1, :after] = GAP
                        raw[side[k] == 2, length - 1 + after:] = GAP
                        rows.append((i, len(k), pack(h[k], doc[k], rid[k], pos[k].astype(np.uint32)), raw.tobytes()))
                kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["shard", "n", "body", "bytes"])

    return run


def radix_repeats(groups: np.ndarray, suffixes: list[np.ndarray], doc: np.ndarray) -> np.ndarray:
    """Rows whose suffix, within its group, also belongs to a smaller document.

    ``suffixes`` holds the digits of all suffixes, most significant first. Each
    pass orders the rows that are left by (group, digit), makes each run a group
    and drops groups of a single document: they can't repeat any more.
    """
    rows = np.arange(len(groups))
    for digit in suffixes:
        if not len(rows):
            break
        order = np.lexsort((digit[rows], groups))
        rows, g, d = rows[order], groups[order], digit[rows[order]]
        new = np.r_[True, (g[1:] != g[:-1]) | (d[1:] != d[:-1])]
        cuts = np.flatnonzero(new)
        own = doc[rows]
        several = np.minimum.reduceat(own, cuts) != np.maximum.reduceat(own, cuts)
        groups = np.cumsum(new) - 1
        keep = several[groups]
        rows, groups = rows[keep], groups[keep]
    if not len(rows):
        return rows
    order, least = _first_of([groups], doc[rows])
    return rows[order][doc[rows[order]] > least]


def _sort_suffixes(length: int, shards: int):
    pad, wide = length - Q, 2 * length - Q
    whole = length // 8
    starts = [*range(0, 8 * whole, 8), *([length - 8] if length % 8 else [])]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        h, doc, rid, pos = _opened(table, ["<i8", "<i8", "<i8", "<u4"])
        raw = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8).reshape(-1, wide)
        order = np.argsort(h, kind="stable")
        cuts = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1], True]) if len(h) else np.zeros(1, np.int64)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        at = 0
        while at + 1 < len(cuts):  # whole anchors, about 64k places at a time
            upto = max(at + 1, int(np.searchsorted(cuts, cuts[at] + 65_536, side="right")) - 1)
            k = order[cuts[at]:cuts[upto]]
            at = upto
            flat = np.r_[raw[k].reshape(-1), np.zeros(8, np.uint8)]
            # suffix o starts o bytes before the anchor
            o = np.tile(np.arange(pad + 1), len(k))
            base = np.repeat(np.arange(len(k)) * wide, pad + 1) + pad - o
            row = np.repeat(np.arange(len(k)), pad + 1)
            inside = (flat[base] != GAP) & (flat[base + length - 1] != GAP)
            o, base, row = o[inside], base[inside], row[inside]
            _, g = np.unique(h[k], return_inverse=True)
            digits = [_load(flat, base + s).byteswap() for s in starts]
            hit = radix_repeats(g[row] * (pad + 1) + o, digits, doc[k][row])
            out.append((rid[k][row[hit]], pos[k][row[hit]].astype(np.int64) - o[hit]))
        r, p = (np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else ([], [])))
        order = np.lexsort((p, r))
        r, p = r[order], p[order]
        same = r[1:] == r[:-1]
        i = np.flatnonzero(np.r_[True, ~(same & (p[1:] <= p[:-1] + length))]) if len(r) else np.zeros(0, np.int64)
        lo, hi = p[i], p[np.r_[i[1:], len(p)] - 1] + length if len(r) else p
        return _dealt(r[i], shards, lo.astype(np.int32), hi.astype(np.int32))

    return run


def _apply(length: int):
    pad = length - Q

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            cols = [b.column(c).to_pylist() for c in ("doc_id", "rid", "text", "full", "lo", "hi")]
            for doc, rid, text, full, lo, hi in zip(*cols):
                n = len(text)
                full = np.array(full or [], np.int64)
                lo = np.r_[np.maximum(full - pad, 0), np.array(lo or [], np.int64)]
                hi = np.r_[np.minimum(full + length, n), np.array(hi or [], np.int64)]
                cover = np.zeros(n + 1, np.int32)
                np.add.at(cover, lo, 1)
                np.add.at(cover, hi, -1)
                gone = np.cumsum(cover[:n]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((doc, rid, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc_id", "rid", "n_removed", "n_spans", "sha", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = 50, keep_text: bool = False, hot_places: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, the
    remaining bytes, on request) for each row of ``docs(doc_id, text)``. Anchors
    with more than ``hot_places`` places are parted by their neighbouring bytes."""
    spark, path = docs.sparkSession, scratch(docs.sparkSession, "suffix-dedup")
    raw = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw.alias("text"))
    rows = rows.withColumn("doc", F.coalesce("doc_id", F.lit(LAST))).withColumn("rid", F.xxhash64("doc_id", "text"))
    rows.select("doc_id", "doc", "rid", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")).write.parquet(f"{path}/base")
    base = spark.read.parquet(f"{path}/base")
    total, count = base.agg(F.sum("n_bytes"), F.count(F.lit(1))).first()
    shards = max(LEAST_SHARDS, -(-(total or 0) // SHARD_BYTES))

    first = base.filter(F.col("n_bytes") >= length).groupBy("sha").agg(
        F.min("doc").alias("_first"), F.max("doc").alias("_last"), F.count(F.lit(1)).alias("_n")).filter("_first < _last")
    # texts that many rows hold: HOT_SHARE of them at most, so they may be broadcast
    often = F.col("_n") * HOT_SHARE > count
    hot = F.broadcast(first.filter(often).select("sha", "_first"))
    copies = base.join(hot, "sha").select("rid", "doc", "_first").unionByName(
        base.join(hot, "sha", "left_anti").join(first.filter(~often), "sha").select("rid", "doc", "_first"))
    copies = copies.filter("doc > _first").select("rid").distinct()

    blobs = rows.select("doc", "rid", "text").mapInArrow(lean(_anchor_blobs(length, shards)), BLOBS)
    found = blobs.groupBy("shard").applyInArrow(_match(shards, hot_places), BLOBS)
    found = found.groupBy("shard").applyInArrow(_unite_places, FOUND).join(copies, "rid", "left_anti")
    found.write.parquet(f"{path}/found")
    del found, blobs
    release(spark)
    found = spark.read.parquet(f"{path}/found")

    opened = found.filter("size(open) > 0").select("rid", "open", "anchor").join(rows.select("rid", "doc", "text"), "rid")
    suffixes = opened.mapInArrow(lean(_suffix_blobs(length, 2 * shards)), "shard int, n int, body binary, bytes binary")
    runs = suffixes.groupBy("shard").applyInArrow(_sort_suffixes(length, shards), BLOBS)
    runs = runs.groupBy("shard").applyInArrow(_unite_runs, "rid long, lo array<int>, hi array<int>")
    runs.write.parquet(f"{path}/runs")
    del runs, suffixes, opened
    release(spark)
    runs = spark.read.parquet(f"{path}/runs")

    spans = found.filter("size(full) > 0").select("rid", "full").join(runs, "rid", "full")
    texts = spans.join(rows.select("rid", "doc_id", "text").dropDuplicates(["rid"]) if keep_text else rows.select("rid", "doc_id", "text"), "rid")
    cut_ = texts.mapInArrow(_apply(length), "doc_id long, rid long, n_removed long, n_spans long, sha string, kept binary")
    cut_ = (cut_ if keep_text else cut_.drop("kept")).withColumnRenamed("sha", "_sha").drop("doc_id").dropDuplicates(["rid"])
    gone = copies.withColumn("_copy", F.lit(True))
    whole = base.join(cut_, "rid", "left").join(gone, "rid", "left")
    pick = lambda copy, other: F.when(F.col("_copy"), copy).otherwise(other)
    out = whole.select(
        "doc_id", "rid", "n_bytes", pick(F.col("n_bytes"), F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        pick(F.lit(1), F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        pick(F.sha2(F.lit("").cast("binary"), 256), F.coalesce("_sha", "sha")).alias("kept_sha256"), *(["kept"] if keep_text else []))
    if keep_text:
        own = rows.select(F.col("rid").alias("_r"), "text").dropDuplicates(["_r"])
        out = out.join(own, F.col("rid") == F.col("_r")).withColumn(
            "kept", F.when(F.col("n_removed") == F.col("n_bytes"), F.lit("").cast("binary")).otherwise(F.coalesce("kept", "text"))).drop("_r", "text")
    return out.drop("rid")
