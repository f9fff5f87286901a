import os

import pytest

from voltlane import scratch


class Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return {"spark.master": "spark://somewhere:7077"}.get(key, default)


def test_a_cluster_must_name_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_folder(Cluster, "x")


def test_folders_can_be_cleared(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_MADE", [])
    table = scratch.staged(spark.range(3), "numbers")
    folder = scratch._MADE[0]
    assert table.count() == 3 and os.path.isdir(folder)
    assert scratch.clear_scratch(spark) == 1 and not os.path.exists(folder)


def test_discard_deletes_one_folder(spark, tmp_path):
    one, at = scratch.staged_at(spark.range(3), "one")
    other, kept = scratch.staged_at(spark.range(4), "other")
    assert one.count() == 3
    scratch.discard(spark, at)
    scratch.free_shuffles(spark)
    assert not os.path.exists(at) and os.path.exists(kept) and other.count() == 4
    assert at not in scratch._MADE and kept in scratch._MADE
