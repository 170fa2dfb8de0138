"""Scratch folders: where they lie, and that they can be removed."""

import os

import pytest

from shoplens import scratch


def test_folders_of_this_process_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_dir", lambda _: str(tmp_path))
    monkeypatch.setattr(scratch, "_made", [])
    frame = scratch.written(spark, spark.range(5), "a")
    scratch.scratch_dir(spark, "never written")
    (tmp_path / "another's").mkdir()
    assert frame.count() == 5 and len(os.listdir(tmp_path)) == 2
    assert scratch.clear_scratch(spark) == 1
    assert os.listdir(tmp_path) == ["another's"] and scratch.clear_scratch(spark) == 0


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_dir(Session)
