"""Benchmark decontamination: size-partitioned MinHash containment search.

Finds documents that contain a benchmark item: at least ``threshold`` of the
item's distinct ``n``-word shingles occur in the document.

An item of ``s`` shingles is cut down to the ``k`` of them with the least hash
values (its bottom-k MinHash sketch). Items are partitioned by size, and each
size class takes ``k = floor((1 - threshold) * largest size) + 1``: a document
that holds ``threshold`` of the item misses fewer than ``k`` of its shingles and
so holds one of the sketch. The search therefore loses nothing, however long the
document: its shingles are looked up in the sketches, and nothing of its size is
compared. Candidates are verified by exact containment of all shingles.

DataFrame functions only. A shingle is the 64-bit hash of its words' hashes. The
document side is exploded and filtered where it is read; only shingles that
stand in a sketch are shuffled.

Defined results: A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``; an item
or document of fewer than ``n`` words has its whole sequence as only shingle; NULL
or blank items and texts take no part; repeated items are searched once for each
``item_id``; repeated documents count as one per ``doc_id``; NULL ids take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import SPACE, cut


def _words(text: str) -> Column:
    lower = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.split(F.regexp_replace(lower, rf"^{SPACE}|{SPACE}$", ""), SPACE)


def shingles(df: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """``(id_col, h)``: the hash of every shingle, with repetitions."""
    w = df.filter(F.col(id_col).isNotNull() & F.col(text_col).rlike(r"[^\x20\x09-\x0D]")).select(id_col, _words(text_col).alias("_w"))
    # word hashes once, then n of them for each shingle
    w = w.select(id_col, F.transform("_w", lambda x: F.xxhash64(x)).alias("_w"), F.greatest(F.lit(0), F.size("_w") - n).alias("_last"))
    at = w.select(id_col, "_w", F.explode(F.sequence(F.lit(0), F.col("_last"))).alias("_i"))
    key = F.xxhash64(*[F.get("_w", F.col("_i") + j) for j in range(n)])
    return at.select(id_col, key.alias("h"))


def sketches(items: DataFrame, threshold: float, width: float = 1.25) -> DataFrame:
    """``(item_id, h, size, in_sketch)``: distinct shingles of every item, and
    whether they stand in the sketch of the item's size class."""
    sets = items.groupBy("item_id").agg(F.array_sort(F.collect_set("h")).alias("_s"))  # one item's shingles
    size = F.size("_s")
    # classes [width^c, width^(c+1)); k for the largest size of the class
    top = F.ceil(F.pow(F.lit(width), F.floor(F.log(width, size.cast("double")) + 1e-9) + 1))
    miss = F.floor(F.greatest(top, size) * F.lit(round(1 - threshold, 9)) + 1e-9)
    sets = sets.select("item_id", size.alias("size"), F.least(size, miss + 1).alias("_k"), "_s")
    return sets.select("item_id", "size", "_k", F.posexplode("_s").alias("_r", "h")).select(
        "item_id", "h", "size", (F.col("_r") < F.col("_k")).alias("in_sketch"))


def leaks(docs: DataFrame, benchmark: DataFrame, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """``doc_id, item_id, item_shingles, found, containment`` of every pair with
    containment of at least ``threshold``."""
    items = cut(sketches(shingles(benchmark, "item_id", "text", n), threshold))
    own = shingles(docs, "doc_id", "text", n)
    wanted = items.select("h").distinct()
    # shingles of any item, found where the text is read if the planner can broadcast them
    hits = cut(own.join(wanted, "h", "left_semi").groupBy("doc_id", "h").agg(F.lit(1).alias("_")).drop("_"))
    candidates = hits.join(items.filter("in_sketch").select("item_id", "h"), "h").select("doc_id", "item_id").distinct()
    found = (candidates.join(items, "item_id").join(hits, ["doc_id", "h"])
             .groupBy("doc_id", "item_id").agg(F.count("*").alias("found"), F.first("size").alias("item_shingles")))
    return found.filter(F.col("found") >= F.ceil(F.col("item_shingles") * F.lit(threshold) - 1e-9)).select(
        "doc_id", "item_id", F.col("item_shingles").cast("long").alias("item_shingles"), "found",
        (F.col("found") / F.col("item_shingles")).alias("containment"))
