"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.session import checkpoint_dir

#: ASCII white space that separates words (as a Java/SQL character class).
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: computed once, lineage cut."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_mod(col: str, m: int):
    """crc32 of the id written as text, modulo ``m`` (NULL id: as the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % m


def words(raw: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text, A-Z lower-cased; NULL is empty.

    ``bytes.lower`` and ``bytes.split`` treat exactly ASCII letters and those
    six white-space bytes.
    """
    return raw.lower().split() if raw else []


def sorted_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of equal ``keys`` from batches that arrive sorted by them; only
    one group (and one batch) is held at a time."""
    rest = None
    for b in batches:
        if not len(b):
            continue
        b = b if rest is None else pd.concat([rest, b], ignore_index=True)
        k = b[keys].to_numpy()
        cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1), len(b)]
        for s, e in zip(cuts[:-2], cuts[1:-1]):
            yield b.iloc[s:e]
        rest = b.iloc[cuts[-2]:]
    if rest is not None:
        yield rest


def parts(df: DataFrame) -> int:
    """Shuffle partitions of the session, the width used for explicit exchanges."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def split_words(texts: pa.Array, lower: bool = True) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of a batch, the code of every word in order, and the number
    of words of each text.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased (``lower``); NULL is
    empty. Splitting and dictionary encoding run in Arrow's kernels.
    """
    uniq, codes, count = word_codes(texts, lower)
    return uniq.cast(pa.large_binary()).to_pylist(), codes, count


def word_codes(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """As ``split_words``, with the distinct words as an Arrow array."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    # a copy without an offset: ascii_lower misreads slices of large strings (pyarrow 23)
    texts = pc.fill_null(pa.concat_arrays([texts, texts[:0]]).cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, count = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not full.all():
        doc = np.repeat(np.arange(len(count)), count)
        flat, count = flat.filter(pa.array(full)), np.bincount(doc[full], minlength=len(count))
    enc = flat.dictionary_encode()
    return enc.dictionary, enc.indices.to_numpy(zero_copy_only=False), count


def byte_slices(texts: pa.Array, most: int = 8_000_000) -> Iterator[slice]:
    """Consecutive slices of about ``most`` bytes (a longer text alone)."""
    n = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    total = np.cumsum(n)
    at = 0
    while at < len(n):
        end = int(np.searchsorted(total, (total[at - 1] if at else 0) + most, side="right"))
        end = max(end, at + 1)
        yield slice(at, end)
        at = end


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers of a local session import this package from where the
    driver found it; on a cluster the package is shipped with the job. Bounds the
    Arrow batches that carry whole texts."""
    import os

    import convoy

    root = os.path.dirname(os.path.dirname(os.path.abspath(convoy.__file__)))
    env = spark.sparkContext.environment
    held = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in held:
        env["PYTHONPATH"] = os.pathsep.join([root, *held])
    return small_batches(spark)


def small_batches(spark: SparkSession, rows: int = 2000) -> SparkSession:
    """Whole texts go to Python in Arrow batches of at most so many rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)
    return spark


@contextmanager
def batch_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Within this, Arrow batches to Python hold about ``most`` bytes at most (a longer row alone)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(key, None)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, was) if was is not None else spark.conf.unset(key)


def lean(run):
    """A batch function whose worker gives freed memory back when a partition ends
    (workers are reused by other steps)."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


def trim() -> None:
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # no glibc


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps now: it does so when
    the driver's garbage is collected, which may be long after."""
    import gc
    import time

    # twice: what the first round frees in Python is dropped in the JVM a moment
    # later, and Spark's cleaner works in a thread of its own
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def pack(*cols: np.ndarray) -> bytes:
    """Columns byte plane by byte plane, compressed."""
    import zstandard as zstd

    raw = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in cols)
    return zstd.ZstdCompressor(level=1).compress(raw)


def unpack(z: bytes, n: int, kinds: list[str]) -> list[np.ndarray]:
    import zstandard as zstd

    raw, out, at = np.frombuffer(zstd.ZstdDecompressor().decompress(z), np.uint8), [], 0
    for k in kinds:
        w = np.dtype(k).itemsize
        out.append(np.ascontiguousarray(raw[at:at + n * w].reshape(w, n).T).reshape(-1).view(k))
        at += n * w
    return out
