"""Property tests of the custom operators against brute-force definitions."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from convoy.operators.expand import expand_range
from convoy.operators.merge import latest_per_key
from convoy.operators.ranking import with_ranks

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=0, max_size=40)


def _rank(vals, asc):
    """rank() with NULLS LAST for ascending, NULLS FIRST for descending."""
    def key(v):
        if v is None:
            return (1, 0) if asc else (0, 0)
        return (0, v) if asc else (1, -v)
    ordered = sorted(key(v) for v in vals)
    return [1 + sum(1 for k in ordered if k < key(v)) for v in vals]


@SETTINGS
@given(a=values, b=values)
def test_with_ranks_matches_definition(spark, a, b):
    n = min(len(a), len(b))
    rows = [(i, a[i], None if b[i] is None else float(b[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, a int, b double")
    want_a = _rank([r[1] for r in rows], True)
    want_b = _rank([r[2] for r in rows], False)
    want = {rows[i][0]: (want_a[i], want_b[i]) for i in range(n)}
    for key in (None, "id"):
        got = with_ranks(df, [("a", "ra", True), ("b", "rb", False)], row_key=key)
        assert {r.id: (r.ra, r.rb) for r in got.collect()} == want


@SETTINGS
@given(ns=st.lists(st.integers(0, 30), min_size=1, max_size=8), chunk=st.integers(1, 7))
def test_expand_range_matches_definition(spark, ns, chunk):
    df = spark.createDataFrame(list(enumerate(ns)), "k int, n int")
    got = sorted((r.k, r.i) for r in expand_range(df, "n", "i", ["k"], chunk=chunk).collect())
    assert got == sorted((k, i) for k, n in enumerate(ns) for i in range(n))


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.text(max_size=2)),
                     min_size=1, max_size=30, unique_by=lambda r: (r[0], r[1])))
def test_latest_per_key_matches_definition(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, v string")
    got = {r.k: (r.ts, r.v) for r in latest_per_key(df, ["k"], "ts").collect()}
    want = {}
    for k, ts, v in rows:
        if k not in want or ts > want[k][0]:
            want[k] = (ts, v)
    assert got == want


@SETTINGS
@given(a=values, b=values)
def test_per_key_rank_path_matches_definition(spark, a, b):
    """bigint and decimal keys take the per-key path (not exact in double)."""
    n = min(len(a), len(b))
    rows = [(i, a[i], b[i]) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, a bigint, b int") \
        .selectExpr("id", "a", "cast(b as decimal(20,2)) as b")
    got = with_ranks(df, [("a", "ra", False), ("b", "rb", True)])
    res = {r.id: (r.ra, r.rb) for r in got.collect()}
    want_a = _rank([r[1] for r in rows], False)
    want_b = _rank([r[2] for r in rows], True)
    assert res == {rows[i][0]: (want_a[i], want_b[i]) for i in range(n)}
