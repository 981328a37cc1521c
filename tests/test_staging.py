"""Where intermediate tables go."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from autostrata.staging import materialize, materialize_counted, staging_root, temporary_area


def _session(master, checkpoint_dir=None, setting=None):
    chosen = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: checkpoint_dir, setCheckpointDir=chosen.append
    )
    conf = SimpleNamespace(get=lambda key, default: setting)
    return SimpleNamespace(sparkContext=context, conf=conf), chosen


def test_the_folder_the_session_names_is_used():
    assert staging_root(_session("yarn", checkpoint_dir="hdfs:/c/1")[0]) == "hdfs:/c/1"
    assert staging_root(_session("yarn", setting="s3a://b/c/")[0]) == "s3a://b/c"


def test_a_cluster_session_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging_root(_session("spark://host:7077")[0])


def test_a_local_session_gets_a_temporary_folder():
    session, chosen = _session("local[2]")
    assert os.path.isdir(staging_root(session))
    assert len(chosen) == 1


def test_copies_keep_rows_and_types_and_count_them(spark):
    df = spark.range(10).select("id", F.when(F.col("id") > 4, "é").alias("t"))
    copy, rows = materialize_counted(df, "t")
    assert rows == 10
    assert copy.dtypes == df.dtypes
    assert sorted(map(tuple, copy.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_a_temporary_area_is_deleted(spark):
    with temporary_area(spark):
        copy = materialize(spark.range(3), "t")
        folder = os.path.dirname(copy.inputFiles()[0].removeprefix("file://"))
        assert copy.count() == 3 and os.path.isdir(folder)
    assert not os.path.exists(folder)
    assert materialize(spark.range(3), "t").count() == 3
