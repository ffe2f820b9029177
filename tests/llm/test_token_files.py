import zlib

import numpy as np
import pyarrow as pa
import pytest

from convoy.llm import token_files as W
from convoy.llm.queries import tokenizer_path

TEXTS = ["Hello, world. It's HELLO; don't!", None, "", "  \n\t ", "Ünï çødé Ａ １２ 汉字 ́x ẖ İ ΑΣ Σ.", "<|endoftext|>x <|STARTOFTEXT|> <|startoftext|>",
         "a.b. c... 12,3 ?! '' 's '", "word " * 3000, "\x1c\x85 q ​ \U0001F600\U0001F600 '", "Hello, world. It's HELLO; don't!"]


def test_ids_equal_whole_text_encoding():
    enc = W.Encoder(tokenizer_path(), most=30)
    for _ in range(2):
        ids, n = enc.encode(pa.array(TEXTS), 1)
        for t, a, z in zip(TEXTS, np.cumsum(n) - n, np.cumsum(n)):
            assert ids[a:z].tolist() == [*enc.tok.encode(t or "", add_special_tokens=False).ids, 1], t


def test_round_trip_and_random_access(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(W, "FRAME", 64)
    rows = [(i * 2, t, "a") for i, t in enumerate(TEXTS * 3)] + [(None, "null id", "a"), (6, "again", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(4)
    manifest = W.write(df, f"{tmp_dir}/t", tokenizer_path(), 1, files=3)
    enc = W.Encoder(tokenizer_path())
    ids = lambda t: [*enc.tok.encode(t or "", add_special_tokens=False).ids, 1]
    want = sorted((-1 if i is None else i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, t, _ in rows for x in [ids(t)])
    got = W.read(manifest).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id or -1 for r in sorted(got, key=lambda r: r.start)][1:] == sorted(i or -1 for i, _, _ in rows if i is not None)
    found = W.lookup(spark, manifest, spark.createDataFrame([(4,), (8,), (8,), (999,)], "doc_id long")).collect()
    assert sorted((r.doc_id, r.ids) for r in found) == [(i, ids(t)) for i, t, _ in rows if i in (4, 8)]


def test_reads_only_wanted_frames_and_checks_sums(tmp_dir):
    path = f"{tmp_dir}/x.ids"
    w = W.FrameWriter(path, frame=16)
    for i in range(20):
        w.add(i, np.arange(i + 1, dtype=np.uint32))
    w.close()
    r = W.FrameReader(path)
    seen, one = [], r._frame
    r._frame = lambda i: seen.append(i) or one(i)
    assert [np.frombuffer(x, "<u4").tolist() for _, x in r.documents([3, 17])] == [list(range(4)), list(range(18))] and len(seen) == 2
    raw = bytearray(open(path, "rb").read())
    raw[int(r.at[1]) + 8] ^= 1
    open(path, "wb").write(raw)
    with pytest.raises(Exception):
        list(W.FrameReader(path).documents())
    # a plain zstandard reader skips the seek table
    import zstandard
    import io
    w = W.FrameWriter(path)
    w.add(1, np.array([7], np.uint32))
    w.close()
    raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(open(path, "rb").read()), read_across_frames=True).read()
    assert raw[:4] == b"\x07\0\0\0" and len(raw) == 4 + W.INDEX.itemsize


def test_empty_table(spark, tmp_dir):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert W.read(W.write(df, f"{tmp_dir}/e", tokenizer_path())).count() == 0


def test_another_tokenizer_is_encoded_whole():
    """What the fast path takes for granted is checked; without it ids are those of the tokenizer."""
    enc = W.Encoder(tokenizer_path())
    assert enc.exact
    texts = pa.array(["One, two. THREE", None, "", "x" * 50], pa.large_string())
    fast = enc.encode(texts, 1)
    enc.exact = False
    slow = enc.encode(texts, 1)
    assert fast[0].tolist() == slow[0].tolist() and fast[1].tolist() == slow[1].tolist()


def test_rows_of_one_id_lie_in_several_files(spark, tmp_dir):
    df = spark.range(400).selectExpr("CASE WHEN id % 4 = 0 THEN id END AS doc_id", "concat('text ', id) AS text")
    made = W.write(df, f"{tmp_dir}/t", tokenizer_path(), files=4)
    n = sorted(r.n_docs for r in made.collect())
    assert sum(n) == 400 and n[-1] <= 200
    got = W.read(made).collect()
    assert len(got) == 400 and sum(r.doc_id is None for r in got) == 300
    assert sorted(r.start for r in got) == [sum(r.n_tokens for r in sorted(got, key=lambda r: r.start)[:i]) for i in range(400)]
