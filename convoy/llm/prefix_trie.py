"""Prefix trie of conversations by whole-sequence collapse.

Conversations are sequences of turns (role, text). Equal sequences are first
collapsed into one with a weight, its least ``conv_id`` as representative, and
the list of conversations that end there; an anti join with all proper prefixes
leaves the leaves. Nodes are then sums over the prefixes of the weighted sequences.

A prefix is known by its length and the exclusive-or of two 64-bit hashes of
each (position, turn), a running value, so that a conversation of any length is
spread over tasks (:mod:`convoy.llm.running`). The nodes whose least member
represents a sequence are a tail of that sequence. A subtree's total is thus the
sum, over the sequences through its top, of what they hold from there on, which
takes one row for each turn.

Rebuilding: conversation ``c`` is given the first ``h`` turns of ``c - c % block``
(all if fewer, none if absent), ``h`` being crc32 of the decimal ``c`` modulo
``share``, and then its own turns after its first ``h``. ``%`` is that of SQL. Turns are
ordered by ``turn`` (NULL first), then role and text; NULL roles and texts are
empty; rows without a ``conv_id`` take no part; repeated rows are turns of their
own. Without rows there are no nodes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut, lean, parts
from convoy.llm.running import running

KEY = ["depth", "x1", "x2"]
#: Ids of a sequence's end list that travel in one row.
PACKED = 8192
#: Rows of one parent are looked up under so many keys.
SALTS = 64


def _zero():
    return F.lit(0).cast("long")


def _turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, n, h1, h2, words)``: numbered turns, known by two hashes."""
    c = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    c = c.select("*", F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "role", "text").alias("h2"),
                 F.expr(r"CAST(size(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)) AS LONG)").alias("words"))
    return running(c, "conv_id", [F.col("at").asc_nulls_first(), F.col("role"), F.col("text")], ["h1", "h2", "words"])


def rebuild(turns: DataFrame, block: int, share: int) -> tuple[DataFrame, DataFrame]:
    """All conversations, and the rebuilt ``(conv_id, i, h1, h2, words)``."""
    convs = turns.groupBy("conv_id").agg(F.max("n").alias("len"))
    drawn = F.crc32(F.col("conv_id").cast("string").cast("binary")) % share
    base = F.col("conv_id") - F.col("conv_id") % block
    known = convs.select(F.col("conv_id").alias("base"), F.col("len").alias("have"))
    plan = convs.select("conv_id", drawn.alias("h"), base.alias("base")).join(known, "base", "left")
    plan = cut(plan.select("conv_id", "base", "h", F.least("h", F.coalesce("have", _zero())).alias("k")))
    # only where the base is short do own turns move
    short = plan.filter("k < h").select("conv_id", (F.col("h") - F.col("k")).alias("by"))
    own = turns.filter(F.col("n") > drawn).join(short, "conv_id", "left").select(
        "conv_id", (F.col("n") - F.coalesce("by", _zero())).alias("i"), "h1", "h2", "words")
    heads = turns.filter((F.col("conv_id") % block == 0) & (F.col("n") < share)).withColumnRenamed("conv_id", "base")
    given = plan.filter("k > 0").join(heads, "base").filter("n <= k").select("conv_id", F.col("n").alias("i"), "h1", "h2", "words")
    return plan.select("conv_id"), own.unionByName(given)


def _packed(batches):
    """Runs of one sequence's ids, in their order, as comma-joined blocks."""
    key, ids = None, []

    def block():
        return pa.RecordBatch.from_pylist([{**dict(zip(KEY, key)), "first": ids[0], "ids": ",".join(map(str, ids))}],
                                          schema=_BLOCK)

    for b in batches:
        for *k, c in zip(*(b[x].to_pylist() for x in [*KEY, "conv_id"])):
            if ids and (k != key or len(ids) == PACKED):
                yield block()
                ids = []
            key = k
            ids.append(c)
    if ids:
        yield block()


def _digests(batches):
    """SHA-256 of the blocks of each sequence, which come in their order."""
    key, state = None, None
    for b in batches:
        for *k, ids in zip(*(b[x].to_pylist() for x in [*KEY, "ids"])):
            if k == key:
                state.update(b",")
            else:
                if key is not None:
                    yield _digest(key, state)
                key, state = k, hashlib.sha256()
            state.update(ids.encode())
    if key is not None:
        yield _digest(key, state)


def _digest(key, state):
    return pa.RecordBatch.from_pydict({**{k: pa.array([v], pa.int64()) for k, v in zip(KEY, key)}, "ends_sha256": [state.hexdigest()]})


_BLOCK = pa.schema([*((k, pa.int64()) for k in KEY), ("first", pa.int64()), ("ids", pa.string())])
_KEY_DDL = ", ".join(f"{k} long" for k in KEY)


def _end_lists(whole: DataFrame) -> DataFrame:
    """``KEY, ends_sha256`` of ``whole(conv_id, KEY)``. A sequence that very many share
    is ranged over tasks and packed, then digested as a stream of blocks."""
    n, order = parts(whole), [*KEY, "conv_id"]
    packed = whole.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(
        lean(_packed), f"{_KEY_DDL}, first long, ids string")
    return packed.repartition(n, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(lean(_digests), f"{_KEY_DDL}, ends_sha256 string")


def trie(conversations: DataFrame, block: int = 20, share: int = 4) -> DataFrame:
    """One row for each node: ``conv_id`` (least member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    convs, rows = rebuild(_turns(conversations), block, share)
    rows = rows.select("conv_id", F.col("i").alias("depth"), F.xxhash64(F.lit(1), "i", "h1", "h2").alias("m1"),
                       F.xxhash64(F.lit(2), "i", "h2", "h1").alias("m2"), "words")
    rows = running(rows, "conv_id", [F.col("depth")], ["depth", "m1", "m2", "words"], xor=["m1", "m2"])

    # whole sequences, collapsed
    ends = rows.groupBy("conv_id").agg(F.count("*").alias("depth"), F.bit_xor("m1").alias("x1"), F.bit_xor("m2").alias("x2"))
    whole = cut(convs.join(ends, "conv_id", "left").select("conv_id", *(F.coalesce(k, _zero()).alias(k) for k in KEY)))
    seqs = cut(whole.groupBy(*KEY).agg(F.count("*").alias("w"), F.min("conv_id").alias("conv_id")))

    # prefixes of the representatives, the root included, with the parent's key
    heads = seqs.select("conv_id", "w", F.col("depth").alias("len"))
    prefixes = rows.select("conv_id", "depth", F.col("run_m1").alias("x1"), F.col("run_m2").alias("x2"),
                           F.col("run_m1").bitwiseXOR(F.col("m1")).alias("p1"), F.col("run_m2").bitwiseXOR(F.col("m2")).alias("p2"), "words")
    roots = heads.select("conv_id", *(_zero().alias(c) for c in ["depth", "x1", "x2", "p1", "p2", "words"]), "w", "len")
    prefixes = cut(prefixes.join(heads, "conv_id").unionByName(roots))

    proper = prefixes.filter("depth < len").select(*KEY).distinct()
    leaves = seqs.join(proper, KEY, "left_anti").select("conv_id", "depth", F.lit(1).cast("long").alias("leaf"))

    # what a node adds to its subtree's total stands in the row of its least member
    owned = prefixes.groupBy(*KEY).agg(F.sum("w").alias("n"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"))
    held = owned.select("conv_id", "depth", ((F.col("n") - 1) * F.col("words")).alias("v")).join(leaves, ["conv_id", "depth"], "left")
    rest = prefixes.drop("words").join(held, ["conv_id", "depth"], "left").select(
        "conv_id", *KEY, "p1", "p2", "w", F.coalesce("v", _zero()).alias("v"), F.coalesce("leaf", _zero()).alias("leaf"))
    rest = running(rest, "conv_id", [F.col("depth").desc()], [*KEY, "p1", "p2", "w"], add=["v", "leaf"])
    nodes = cut(rest.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.sum("w").alias("n_convs"), F.sum("run_leaf").alias("n_leaves"),
                                       F.sum("run_v").alias("saved_tokens"), F.max("p1").alias("p1"), F.max("p2").alias("p2")))

    above = {"depth": "pd", "x1": "p1", "x2": "p2"}
    child = nodes.filter("depth > 0").select(*KEY, (F.col("depth") - 1).alias("pd"), "p1", "p2", F.pmod("x1", F.lit(SALTS)).alias("salt"))
    some = child.groupBy("pd", "p1", "p2", "salt").agg(F.count("*").alias("n"))
    # a parent of any number of children is joined with at most SALTS rows
    n_children = some.groupBy("pd", "p1", "p2").agg(F.sum("n").alias("n_children")).withColumnsRenamed({v: k for k, v in above.items()})
    parents = some.join(nodes.select("conv_id", *KEY).withColumnsRenamed({**above, "conv_id": "parent_conv_id"}), ["pd", "p1", "p2"])
    found = child.join(parents.drop("n"), ["pd", "p1", "p2", "salt"]).select(*KEY, "parent_conv_id")
    out = nodes.join(found, KEY, "left").join(n_children, KEY, "left").join(_end_lists(whole), KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", _zero()).alias("n_children"), "n_leaves",
                      "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
