from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from seriesengine import scratch


def fake_session(shared, context_dir, master):
    context = SimpleNamespace(
        applicationId="app-1", master=master, getCheckpointDir=lambda: context_dir
    )
    conf = SimpleNamespace(get=lambda key, default: shared)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_clusters_folder_comes_first():
    session = fake_session("hdfs:///shared/", "hdfs:///other", "yarn")
    assert scratch.scratch_dir(session) == "hdfs:///shared/seriesengine/app-1"
    session = fake_session(None, "hdfs:///other", "yarn")
    assert scratch.scratch_dir(session) == "hdfs:///other/seriesengine/app-1"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(fake_session(None, None, "yarn"))


def test_materialized_rows_and_metrics(spark):
    df = spark.range(10).withColumn("odd", F.col("id") % 2)
    stored, seen = scratch.materialize(df, "t", biggest=F.max("id"))
    assert seen == {"biggest": 9}
    assert stored.schema.names == df.schema.names
    assert stored.exceptAll(df).count() == 0 and stored.count() == 10
    assert scratch.materialize(df.limit(0), "t", biggest=F.max("id"))[1] == {"biggest": None}
