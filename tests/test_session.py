import os

import pytest

from convoy.session import CLUSTER_CONF, checkpoint_dir, configure
from convoy.sources import sinks


def test_checkpoint_dir_uses_the_session_setting(spark):
    current = checkpoint_dir(spark)
    assert current
    assert checkpoint_dir(spark) == current          # stable, no new folder per call


def test_configure_for_scale_sets_cluster_conf(spark):
    before = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        configure(spark, scale=True)
        for k, v in CLUSTER_CONF.items():
            assert spark.conf.get(k) == v
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_append_table_declared_schema(spark, tmp_dir):
    from pyspark.sql import types as T
    declared = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])
    ok = spark.createDataFrame([(1, "a")], declared)
    sinks.append_table(ok, os.path.join(tmp_dir, "t"), expected=declared)
    wrong = spark.createDataFrame([(1, 2)], "id int, v int")
    with pytest.raises(sinks.SchemaMismatch):
        sinks.append_table(wrong, os.path.join(tmp_dir, "t"), expected=declared)
