"""Scratch folder, scoped settings and file-system helpers."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from shelfmark.session import scratch_path, session_conf
from shelfmark.storage import delete_tree, glob_paths, path_exists


def fake(master, checkpoint=None, context_folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: checkpoint)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: context_folder)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_scratch_uses_the_shared_folder():
    first, second = (scratch_path(fake("yarn", "hdfs://shared/x/"), "stage") for _ in range(2))
    assert first.startswith("hdfs://shared/x/shelfmark/stage-") and first != second
    assert scratch_path(fake("yarn", None, "hdfs://ctx"), "a").startswith("hdfs://ctx/shelfmark/a-")


def test_scratch_is_never_machine_local_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(fake("spark://host:1"), "stage")
    assert "shelfmark-" in scratch_path(fake("local[2]"), "stage")


def test_settings_are_put_back(spark):
    key, fresh = "spark.sql.shuffle.partitions", "spark.shelfmark.test"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), session_conf(spark, {key: "7", fresh: "x"}):
        assert (spark.conf.get(key), spark.conf.get(fresh)) == ("7", "x")
        1 / 0
    assert spark.conf.get(key) == before and spark.conf.get(fresh, None) is None


def test_file_helpers(spark, tmp_path):
    (tmp_path / "a=1" / "b=2").mkdir(parents=True)
    root = str(tmp_path)
    assert path_exists(spark, f"{root}/a=1") and not path_exists(spark, f"{root}/a=2")
    assert [path.rsplit("/", 1)[1] for path in glob_paths(spark, f"{root}/a=1/b=*")] == ["b=2"]
    assert glob_paths(spark, f"{root}/a=2/b=*") == []
    delete_tree(spark, f"{root}/a=1")
    assert not path_exists(spark, f"{root}/a=1")
    delete_tree(spark, f"{root}/a=1")


def test_overlapping_blocks_share_a_setting(spark):
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    first, second = session_conf(spark, {key: "false"}), session_conf(spark, {key: "false"})
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(key) == "false"
    second.__exit__(None, None, None)
    assert spark.conf.get(key) == before
