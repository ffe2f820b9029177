"""Token-id files: independent zstandard frames and a trailing seek table.

A file holds, in this order,

* data frames: the little-endian unsigned 32-bit ids of whole documents;
* one index frame: id (int64), NULL flag (uint8) and number of ids (uint64) of
  each document, in file order;
* a skippable frame with the seek table of the public zstandard "seekable
  format": compressed size, decompressed size and the low 32 bits of the
  XXH64 of the content for each frame, then the number of frames, a descriptor
  (bit 7: checksums are present) and the magic number.

A reader fetches the seek table from the end, the index, and then only the
frames of the documents asked for, whose checksums it verifies.

Files are range partitions of the id (and of the text's hash, so that one id's rows
may lie in several files); files in order hold ascending ids. A
task writes to a name of its own attempt; only files that the written manifest
lists count, so a lost executor or a second attempt leaves nothing behind that
a reader could see.

Defined results: NULL and empty texts hold the end id alone; a NULL id comes
first; repeated ids keep all rows; no rows give no file; other columns are ignored.
"""

from __future__ import annotations

import itertools
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convoy.llm.common import byte_slices, lean, parts, scratch, word_codes

#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE, HAS_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY, FOOTER = struct.Struct("<III"), struct.Struct("<IBI")
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u8")])
#: Bytes of ids after which a frame is closed (at the end of a document).
FRAME = 1 << 18
#: Whether a byte is an ASCII letter or digit.
ALNUM = np.array([bytes([i]).isalnum() for i in range(256)])
MANIFEST = "part int, file string, n_docs long, n_ids long"
DOCUMENTS = "doc_id long, part int, at long, n_tokens long, ids_crc32 long"


class Encoder:
    """Ids of texts, by way of each distinct piece between ASCII white space.

    The tokenizer drops white space and never looks across it, so a text's ids
    are the ids of its pieces in order. Sentence marks behind a letter or digit are
    set apart in Arrow's kernels, so that only what stands before them is looked up.
    Distinct pieces are encoded once, many in one call; beyond ``most`` of them the
    store drops those that fewest batches held. In a call of words of letters alone, a
    token with the end-of-word suffix closes a word; other pieces are set apart
    by a special token, and pieces that hold that token are encoded one by one."""

    def __init__(self, path: str, most: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok, self.most = Tokenizer.from_file(path), most
        added = [t.content for t in self.tok.get_added_tokens_decoder().values() if t.special]
        self.mark = added[0] if added else None
        self.mark_id = self.tok.token_to_id(self.mark) if added else -1
        suffix, size = getattr(self.tok.model, "end_of_word_suffix", None), self.tok.get_vocab_size()
        self.closes = None
        if suffix:
            self.closes = np.zeros(size, bool)
            self.closes[[i for t, i in self.tok.get_vocab().items() if t.endswith(suffix)]] = True
        self.clear()
        self.exact = self._agrees()
        self.clear()

    def _agrees(self) -> bool:
        """Whether ids put together from pieces equal the tokenizer's on samples of what
        is taken for granted: white space parts, case is folded, sentence marks stand
        alone. If not, whole texts are encoded."""
        samples = ["The quick  Brown fox.", "HELLO, hello; Hello: hello!?", "x.y z... 3.5, a.b.", "tab\tand\nline \x0b end", "Ünïcode Größe; ÉTÉ.",
                   "don't (stop) [now] 12,000!", "<mark> a<b>c </s>", "İstanbul ßs 日本語。 e\u0301.", " lead and trail ", "", "McDonald's iPhone U.S.A.", "a" * 200 + "."]
        ids, n = self._pieces(pa.array(samples, pa.large_string()), 0)
        want = [[*x.tolist(), 0] for x in self._ids(samples)]
        return n.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]

    def clear(self) -> None:
        self.rows: dict[bytes, int] = {b"": 0}
        self.flat, self.start = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.n, self.met = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _shrink(self) -> None:
        """Keep the half of the store that most batches have met."""
        keep = np.zeros(len(self.n), bool)
        keep[np.argsort(-self.met, kind="stable")[:self.most // 2]] = True
        keep[0] = True
        row = (np.cumsum(keep) - 1).tolist()
        ids, n = self._gather(np.flatnonzero(keep))
        self.rows = {w: row[r] for w, r in self.rows.items() if keep[r]}
        self.flat, self.n, self.start, self.met = ids, n, np.cumsum(n) - n, self.met[keep] // 2

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _store(self, flat: list[np.ndarray], n: np.ndarray) -> None:
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(n) - n])
        self.n = np.concatenate([self.n, n])
        self.met = np.concatenate([self.met, np.zeros(len(n), np.int64)])
        self.flat = np.concatenate([self.flat, *flat])

    def _encode(self, new: list[bytes]) -> None:
        """Store the ids of pieces that aren't in ``rows`` yet."""
        text = [w.decode("utf-8", "replace") for w in new]
        letters, other, names, flat, size = [], [], [], [], []
        for w, t in zip(new, text):
            (letters if self.closes is not None and t.isalpha() and t.lower().isalpha() else other).append((w, t))
        for s in range(0, len(letters), 512):
            own = letters[s:s + 512]
            ids = self._ids([" ".join([t for _, t in own])])[0]
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(own) or ends[-1] != len(ids):
                other += own
                continue
            names += [w for w, _ in own]
            flat.append(ids)
            size.append(np.diff(ends, prepend=0))
        plain = [x for x in other if self.mark and self.mark not in x[1]]
        rest = [x for x in other if not (self.mark and self.mark not in x[1])]
        for s in range(0, len(plain), 512):
            own = plain[s:s + 512]
            ids = self._ids(["".join([f" {t} {self.mark}" for _, t in own])])[0]
            marks = np.flatnonzero(ids == self.mark_id)
            names += [w for w, _ in own]
            flat.append(ids[ids != self.mark_id])
            size.append(np.diff(marks, prepend=-1) - 1)
        got = self._ids([t for _, t in rest])
        names += [w for w, _ in rest]
        size.append(np.array([len(x) for x in got], np.int64))
        self.rows.update(zip(names, range(len(self.n), len(self.n) + len(names))))
        self._store(flat + got, np.concatenate(size))

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _take(self.flat, self.start, self.n, at)

    def _rows(self, pieces: pa.Array) -> np.ndarray:
        """The store's row of each piece; pieces that it lacks are encoded."""
        enc = pieces.dictionary_encode()
        keys = enc.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self.rows.get, keys, itertools.repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            self._encode([keys[i] for i in new])
            at[new] = [self.rows[keys[i]] for i in new]
        self.met[at] += 1
        return at[enc.indices.to_numpy(zero_copy_only=False)]

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, ``end`` after each text, and the number of each text's ids."""
        if self.exact:
            return self._pieces(texts, end)
        got = [np.append(x, np.uint32(end)) for x in self._ids([t or "" for t in texts.to_pylist()])]
        return np.concatenate(got) if got else np.zeros(0, np.uint32), np.array([len(x) for x in got], np.int64)

    def _pieces(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.rows) > self.most:
            self._shrink()
        uniq, codes, count = word_codes(texts, lower=False)
        stop = np.cumsum(count)
        base, tail = _base_and_tail(uniq)
        both = np.stack([self._rows(base), self._rows(tail)], axis=1).reshape(-1)
        flat, n = self._gather(both)
        flat, n = np.append(flat, np.uint32(end)), np.append(n.reshape(-1, 2).sum(1), 1)  # the end id is the last row
        at = np.insert(codes.astype(np.int64), stop, len(n) - 1)  # ... and comes after each text
        ids, n = _take(flat, np.cumsum(n) - n, n, at)
        first = stop - count + np.arange(len(count))
        return ids, np.add.reduceat(n, first) if len(count) else np.zeros(0, np.int64)


def _take(flat: np.ndarray, start: np.ndarray, n: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``at`` of ``flat`` one after another, and their lengths."""
    n = n[at]
    return flat[np.repeat(start[at] - np.cumsum(n) + n, n) + np.arange(n.sum())], n


def _base_and_tail(pieces: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Pieces parted before the sentence marks that follow an ASCII letter or digit
    (a token of their own); ASCII pieces in lower case (the tokenizer folds case)."""
    plain = pc.and_(pc.string_is_ascii(pieces), pc.invert(pc.match_substring(pieces, "<")))
    text = pc.if_else(plain, pc.ascii_lower(pieces), pieces)
    base = pc.ascii_rtrim(text, ".,;:!?")
    whole, kept = (pc.binary_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (text, base))
    raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    start = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text)]
    parted = (kept > 0) & (kept < whole)
    parted[parted] = ALNUM[raw[(start + kept)[parted] - 1]]
    n = np.where(parted, whole - kept, 0)
    marks, _ = _take(raw, start + kept, n, np.arange(len(n)))
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    tail = pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(marks)])
    return pc.if_else(pa.array(parted), base, text), tail


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class FrameWriter:
    """One token-id file; ``add`` takes whole documents."""

    def __init__(self, path: str, frame: int = FRAME, level: int = 1):
        import xxhash
        import zstandard

        where, p = _fs(path)
        self.out, self.zstd, self.xxh = where.open_output_stream(p), zstandard.ZstdCompressor(level=level), xxhash.xxh64_intdigest
        self.frame, self.table, self.index, self.held, self.size = frame, [], [], [], 0

    def _frame(self, raw: bytes) -> None:
        z = self.zstd.compress(raw)
        self.out.write(z)
        self.table.append(ENTRY.pack(len(z), len(raw), self.xxh(raw) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.index.append((doc_id or 0, doc_id is None, len(ids)))
        self.held.append(ids.astype("<u4", copy=False).tobytes())
        self.size += len(self.held[-1])
        if self.size >= self.frame:
            self.flush()

    def flush(self) -> None:
        if self.held:
            self._frame(b"".join(self.held))
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        self._frame(np.array(self.index, INDEX).tobytes())
        body = b"".join(self.table) + FOOTER.pack(len(self.table), HAS_CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()


class FrameReader:
    """Random access to one token-id file."""

    def __init__(self, path: str):
        where, p = _fs(path)
        self.file = where.open_input_file(p)
        end = self.file.size()
        n, flags, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, end - FOOTER.size))
        if magic != SEEKABLE or not flags & HAS_CHECKSUMS:
            raise ValueError(f"{path}: no seek table with checksums")
        raw = self.file.read_at(n * ENTRY.size, end - FOOTER.size - n * ENTRY.size)
        self.table = np.array([ENTRY.unpack_from(raw, i * ENTRY.size) for i in range(n)], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        self.index = np.frombuffer(self._frame(n - 1), INDEX)
        self.first = np.concatenate([[0], np.cumsum(self.index["n"].astype(np.int64))])  # in ids
        self.frames = np.concatenate([[0], np.cumsum(self.table[:-1, 1])]) // 4

    def _frame(self, i: int) -> bytes:
        import xxhash
        import zstandard

        z, size, check = self.table[i]
        raw = zstandard.ZstdDecompressor().decompress(self.file.read_at(int(z), int(self.at[i])), max_output_size=int(size))
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {i}: checksum does not match")
        return raw

    def documents(self, rows: list[int] | None = None) -> Iterator[tuple[int, bytes]]:
        """``(row, id bytes)`` of the wanted rows of the index (all if None);
        a frame without a wanted row is not read."""
        held, raw = -1, b""
        for r in range(len(self.index)) if rows is None else sorted(rows):
            f = int(np.searchsorted(self.frames, self.first[r], side="right")) - 1
            if f != held:
                held, raw = f, self._frame(f)
            s = 4 * int(self.first[r] - self.frames[f])
            yield r, raw[s:s + 4 * int(self.index["n"][r])]


_ENCODERS: dict[str, Encoder] = {}


def write(docs: DataFrame, folder: str, tokenizer: str, end: int = 1, files: int | None = None) -> DataFrame:
    """Write ``docs(doc_id, text)`` as token-id files below ``folder`` and return
    the manifest (read from where it was written): part, file, n_docs, n_ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = Encoder(tokenizer)
        enc, out, n_docs, n_ids = _ENCODERS[tokenizer], None, 0, 0
        part = TaskContext.get().partitionId()
        file = f"{folder}/files/part-{part:06d}-{uuid.uuid4().hex}.ids"
        for b in batches:
            for s in byte_slices(b.column("text")):
                own = b.slice(s.start, s.stop - s.start)
                if out is None:
                    where, p = _fs(f"{folder}/files")
                    where.create_dir(p, recursive=True)
                    out = FrameWriter(file)
                ids, n = enc.encode(own.column("text"), end)
                cuts = np.cumsum(n)
                for d, a, z in zip(own.column("doc_id").to_pylist(), cuts - n, cuts):
                    out.add(d, ids[a:z])
                n_docs, n_ids = n_docs + len(n), n_ids + len(ids)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [file], "n_docs": [n_docs], "n_ids": [n_ids]})

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    rows = rows.repartitionByRange(files or parts(docs), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    rows.mapInArrow(lean(run), MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32. One task reads one file, frame by frame."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, file in zip(b["part"], b["file"]):
                r = FrameReader(file)
                n = r.index["n"].astype(np.int64)
                crc = np.fromiter((zlib.crc32(x) for _, x in r.documents()), np.int64, len(n))
                ids = pd.array(r.index["doc_id"], dtype="Int64")
                ids[r.index["null"] == 1] = pd.NA
                yield pd.DataFrame({"doc_id": ids, "part": part, "at": r.first[:-1], "n_tokens": n, "ids_crc32": crc})

    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = manifest.select(F.col("part").alias("_p"), before.alias("_before"))  # one row a file
    files = manifest.select("part", "file").repartition(parts(manifest), "part")
    docs = files.mapInPandas(run, DOCUMENTS)
    return docs.join(F.broadcast(first), docs["part"] == first["_p"]).select(
        "doc_id", (F.col("_before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, tokenizer: str, end: int = 1) -> DataFrame:
    return read(write(docs, scratch(docs.sparkSession, "token-files"), tokenizer, end))


def lookup(spark: SparkSession, manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id, ids`` of the documents in ``wanted(doc_id)``; only their frames are decompressed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, ids in zip(b["file"], b["ids"]):
                r = FrameReader(file)
                rows = np.flatnonzero(np.isin(r.index["doc_id"], ids) & (r.index["null"] == 0)).tolist()
                got = [(int(r.index["doc_id"][i]), np.frombuffer(x, "<u4").astype(np.int64)) for i, x in r.documents(rows)]
                yield pd.DataFrame(got, columns=["doc_id", "ids"])

    spans = manifest.select("part", "file").mapInPandas(_spans, "file string, lo long, hi long")
    want = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    hit = want.join(F.broadcast(spans), (want["doc_id"] >= spans["lo"]) & (want["doc_id"] <= spans["hi"]))
    return hit.groupBy("file").agg(F.collect_list("doc_id").alias("ids")).mapInPandas(run, "doc_id long, ids array<long>")


def _spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for file in b["file"]:
            own = FrameReader(file).index
            own = own["doc_id"][own["null"] == 0]
            if len(own):
                yield pd.DataFrame({"file": [file], "lo": [own.min()], "hi": [own.max()]})
