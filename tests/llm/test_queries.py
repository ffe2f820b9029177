import zlib

import duckdb
import numpy as np
import pytest
from .conftest import SF

from convoy.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_every_operator_is_registered():
    assert [int(k[2:].split("_")[0]) for k in QUERIES] == list(range(1, len(QUERIES) + 1))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def _rows(spark, name):
    got = QUERIES[name](spark, SF).collect()
    return {r.doc_id: r for r in got}, got


def test_op1(spark, documents):
    by, got = _rows(spark, "op1_toxicity")
    assert len(got) == len(documents) == len(by)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for i, r in by.items())


def test_op2(spark, documents):
    from .test_ngram_join import brute
    by, _ = _rows(spark, "op2_ngram_join")
    want = brute([(i, r.text) for i, r in documents.items()], 4, 85)
    assert {i: (r.n_shingles, r.component_id, r.n_links) for i, r in by.items()} == want


def test_op3(spark):
    v = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x, ids = np.array([r.embedding for r in v], float), np.array([r.vec_id for r in v])
    got = {}
    for r in QUERIES["op3_ann"](spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = total = 0
    for i in np.flatnonzero(ids % 100 == 0):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        want = set(ids[np.lexsort((ids, d))[:10]].tolist())
        hit, total = hit + len(want & got[ids[i]]), total + len(want)
    assert hit >= 0.9 * total


def test_op6(spark, documents):
    from .test_suffix_dedup import brute
    by, _ = _rows(spark, "op6_suffix_dedup")
    for i, n, removed, spans, sha, _ in brute([(i, r.text) for i, r in documents.items()], 50):
        assert tuple(by[i])[1:] == (n, removed, spans, sha)


def test_op9(spark, documents):
    from tokenizers import Tokenizer

    from convoy.llm.queries import tokenizer_path
    by, _ = _rows(spark, "op9_token_files")
    tok, at = Tokenizer.from_file(tokenizer_path()), 0
    for i in sorted(documents):
        ids = [*tok.encode(documents[i].text or "", add_special_tokens=False).ids, 1]
        assert (by[i].start, by[i].n_tokens, by[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_op10(spark, documents):
    by, _ = _rows(spark, "op10_language_id")
    held = [(r.lang_pred, documents[i].lang) for i, r in by.items() if r.held_out]
    assert len(by) == len(documents) and sum(a == b for a, b in held) >= 0.9 * len(held)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in by.items())
