import pytest

from convoy.llm.common import importable

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    importable(spark)


@pytest.fixture()
def docs_of(spark):
    """``documents``-like rows with an extra column whose name an operator also uses."""
    def make(texts, start=0, **more):
        rows = [(start + i, t, *[v[i] for v in more.values()], "x") for i, t in enumerate(texts)]
        extra = "".join(f", {k} string" for k in more)
        return spark.createDataFrame(rows, f"doc_id long, text string{extra}, score string")
    return make
