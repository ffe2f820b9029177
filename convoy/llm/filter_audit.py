"""Filter interaction audit: what five filters remove in every order.

Filters over whole texts (NULL is the empty text; words are
``[^\\x20\\x09-\\x0D]+``): A too few words, B too few distinct words, C too many
capitals, D a listed symbol, E the text of a smaller ``doc_id``.

E is found with radix tries. Each task inserts its whole texts into a compressed
trie that holds the least id at every terminal. Rows above that least id are
duplicates and go on without their text, so of a text with any number of copies
one row a task is shuffled. What is left is range-partitioned by adaptive
text prefixes (:mod:`convoy.llm.text_ranges`) and inserted into tries again, in
the order of the texts, so that a full trie can be emptied between two texts; a
traversal flags the duplicates. Documents are then masks of five bits, and all
orders follow from the counts of masks.

Definitions: a row without an id never fails E, nor does it make another fail; of
rows with equal id and text none is the smaller. A label counts if any row of
its id has it. Extra columns are left alone.
"""

from __future__ import annotations

import itertools
from bisect import bisect_right

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import byte_slices, lean, parts
from convoy.llm.text_ranges import bounds
from convoy.llm.text_trie import Trie

FILTERS = "ABCDE"
COPY = 16
#: Bytes on the edges and rows of a trie before it is emptied.
FULL_BYTES, FULL_ROWS = 32_000_000, 200_000

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MASKS = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64()),
                    ("r", pa.int32()), ("text", pa.binary())])
_MASKS_DDL = "doc_id long, part string, mask int, n long, r int, text binary"


def _fails(raw: bytes, points: int, words: int, distinct: int, capitals: int, symbols: bytes) -> int:
    found = raw.split()  # splits at exactly the six white-space bytes
    return ((len(found) < words)
            + 2 * (100 * len(set(found)) < distinct * len(found))
            + 4 * (100 * (len(raw) - len(raw.translate(None, _UPPER))) > capitals * points)
            + 8 * (len(raw.translate(None, symbols)) < len(raw)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _MASKS)], schema=_MASKS)


def _settled(trie: Trie, spread: int):
    """Rows of a full trie: duplicates without a text, the least of each text with
    it, counted by part (rows of one id and text may differ in it)."""
    for text, least, rows in trie.terminals():
        first = {}
        for ident, (part, mask, n) in rows:
            if ident > least:
                spread += 1
                yield ident, part, mask | COPY, n, -spread, None
            else:
                first[part, mask] = first.get((part, mask), 0) + n
        for (part, mask), n in first.items():
            yield least, part, mask, n, 0, text


def _emptied(trie: Trie, cuts: list[bytes] | None, ranges: int):
    """Batches of a trie's rows; ``cuts`` deals texts to ranges, other rows evenly."""
    out, size = [], 0
    for ident, part, mask, n, r, text in _settled(trie, 0):
        r = bisect_right(cuts, text) if cuts is not None and text is not None else -r % ranges
        out.append((ident, part, mask, n, r, text if cuts is not None else None))
        size += len(text or b"") + 40
        if size > 8_000_000 or len(out) >= 5_000:
            yield _batch(out)
            out, size = [], 0
    if out:
        yield _batch(out)


def _masks_of(limits: dict, cuts: list[bytes], ranges: int, full: int):
    def run(batches):
        trie, held, lone = Trie(), 0, 0
        for b in batches:
            text = b["text"].cast(pa.large_binary())
            for s in byte_slices(text):
                part = pc.fill_null(b["part"].slice(s.start, s.stop - s.start), "").to_pylist()
                ids = b["doc_id"].slice(s.start, s.stop - s.start).to_pylist()
                points = pc.fill_null(pc.utf8_length(b["text"].slice(s.start, s.stop - s.start)), 0).to_pylist()
                raws = pc.fill_null(text.slice(s.start, s.stop - s.start), b"").to_pylist()
                alone = []
                for ident, p, raw, k in zip(ids, part, raws, points):
                    mask = _fails(raw, k, **limits)
                    if ident is None:
                        lone += 1
                        alone.append((None, p, mask, 1, lone % ranges, None))
                    else:
                        trie.insert(raw, ident, (p, mask, 1))
                        held += 1
                if alone:
                    yield _batch(alone)
                if trie.size > full or held > FULL_ROWS:
                    yield from _emptied(trie, cuts, ranges)
                    trie, held = Trie(), 0
        yield from _emptied(trie, cuts, ranges)

    return run


def _copies(full: int):
    """Rows in the order of their texts: one trie at a time, emptied between texts."""
    def run(batches):
        trie, held, last = Trie(), 0, None
        for b in batches:
            done = []
            for ident, part, mask, n, r, text in zip(*(c.to_pylist() for c in b.columns)):
                if text is None:
                    done.append((ident, part, mask, n, r, None))
                    continue
                if text != last and (trie.size > full or held > FULL_ROWS):
                    yield from _emptied(trie, None, 1)
                    trie, held = Trie(), 0
                trie.insert(text, ident, (part, mask, n))
                held, last = held + 1, text
            if done:
                yield _batch(done)
        yield from _emptied(trie, None, 1)

    return run


def masks(docs: DataFrame, words: int = 200, distinct: int = 50, capitals: int = 3, symbols: str = "#$%&*|",
          full: int = FULL_BYTES) -> DataFrame:
    """``(doc_id, part, mask, n)``: the filters that ``n`` rows of an id fail, as bits
    in the order of :data:`FILTERS`. ``docs`` has ``doc_id``, ``text``, ``lang``.
    """
    width = parts(docs)
    ranges = 4 * width
    cuts = bounds(docs, "text", ranges)
    limits = {"words": words, "distinct": distinct, "capitals": capitals, "symbols": symbols.encode()}
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("part"), "text")
    dealt = own.mapInArrow(lean(_masks_of(limits, cuts, ranges, full)), _MASKS_DDL)
    sorted_ = dealt.repartition(width, "r").sortWithinPartitions("text")
    found = sorted_.mapInArrow(lean(_copies(full)), _MASKS_DDL)
    return found.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))


def orders(counts: DataFrame) -> DataFrame:
    """The audit table of ``counts(part, mask, n, good, toxic)``, one row for each mask."""
    steps = []
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for i, f in enumerate(order, 1):
            steps.append(("".join(FILTERS[x] for x in order), i, 1 << f, before))
            before |= 1 << f
    fixed = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(i).alias("step"), F.lit(bit).alias("bit"),
                               F.lit(before).alias("before")) for o, i, bit, before in steps])
    rows = counts.select("*", F.explode(fixed).alias("s")).select("part", "mask", "n", "good", "toxic", "s.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    out = F.col("mask").bitwiseAND(F.col("before")) != 0
    # a row failing k filters is removed by each of them in 1 of k orders
    share = F.expr("CAST(n * (120 div bit_count(mask)) AS LONG)")

    def total(when, what):
        return F.sum(F.when(when, what).otherwise(F.lit(0).cast("long")))

    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~out, F.col("n")).alias("kept"),
        total(fails & ~out, F.col("n")).alias("removed"),
        total(fails & out, F.col("n")).alias("redundant"),
        total(F.col("mask") == F.col("bit"), F.col("n")).alias("unique_fails"),
        total(fails & ~out, F.col("good")).alias("good_lost"),
        total(fails & ~out, F.col("toxic")).alias("toxic_lost"),
        total(fails, share).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    """One row for each part (``lang``, NULL as the empty string), order and step; see
    :func:`masks` for the limits. No rows give no parts."""
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("g"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("t"))
    joined = masks(docs, **limits).join(known, "doc_id", "left")
    counts = joined.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("g"), F.col("n")).otherwise(F.lit(0).cast("long"))).alias("good"),
        F.sum(F.when(F.col("t"), F.col("n")).otherwise(F.lit(0).cast("long"))).alias("toxic"))
    return orders(counts.repartition("part"))
