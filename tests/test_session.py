"""Sizes and folders a session decides on."""

from types import SimpleNamespace

import pytest

from tidemark.session import PARTITION_BYTES, TASK_BYTES, shared_dir, shuffle_partitions, sized_shuffles


def test_shuffles_grow_with_the_input():
    assert shuffle_partitions(200, 10 * 2**20) == 200
    assert shuffle_partitions(200, 2**40) == 4096
    assert shuffle_partitions(200, 100 * 2**40) == 100 * 2**40 / PARTITION_BYTES == 409_600
    assert shuffle_partitions(500_000, 100 * 2**40) == 500_000


def test_sized_shuffles_gives_the_setting_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(KeyError), sized_shuffles(spark, 2**32):
        assert spark.conf.get(key) == "16"
        raise KeyError
    assert spark.conf.get(key) == before


def session(master: str, **conf: str):
    """As much of a session as the choice of a folder looks at."""
    context = SimpleNamespace(master=master, applicationId="app-1")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_folder_of_the_cluster_comes_first():
    named = {"spark.checkpoint.dir": "hdfs:///shared/"}
    assert shared_dir(session("yarn", **named)) == "hdfs:///shared"
    assert shared_dir(session("local[2]", **named)) == "hdfs:///shared"


def test_only_a_local_session_gets_a_temporary_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))
    assert shared_dir(session("local[2]")) == shared_dir(session("local[2]"))


def test_sized_shuffles_bound_what_a_task_sorts_and_hashes(spark):
    keys = [f"spark.sql.adaptive.{k}" for k in ("advisoryPartitionSizeInBytes", "maxShuffledHashJoinLocalMapThreshold")]
    before = [spark.conf.get(k) for k in keys]
    with sized_shuffles(spark, 2**40):
        assert [int(spark.conf.get(k)) for k in keys] == [TASK_BYTES, TASK_BYTES]
    assert [spark.conf.get(k) for k in keys] == before
