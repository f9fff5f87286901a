"""The compacted view kept up as the log grows, against the view of the whole log."""

import random

import pytest
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.operators import topics, versions
from voltlane.plans import jobs

LOG = "topic string, key string, value string, offset long"


def made_log(spark, seed, n=600, partitions=1):
    """Two topics with offsets of their own; keys come back after their tombstones."""
    rng = random.Random(seed)
    rows, offsets = [], {}
    for _ in range(n):
        topic, key = rng.choice("ab"), f"k{rng.randrange(40)}"
        own = (topic, hash(key) % partitions)
        at = offsets[own] = offsets.get(own, -1) + rng.randint(1, 3)
        value = None if rng.random() < 0.2 else f"v{rng.randrange(99)}"
        rows.append((topic, key, value, at * S.PARTITIONS + own[1] if partitions > 1 else at))
    return rows


def view(df):
    return sorted((r.topic, r.key, r.value, r.offset) for r in df.collect())


@pytest.mark.parametrize("partitions", [1, 5])
def test_kept_up_equals_the_whole(spark, tmp_path, partitions):
    path, rows = str(tmp_path / "t"), made_log(spark, 3, partitions=partitions)
    for upto in (200, 201, 201, 450, 600):
        log = spark.createDataFrame(rows[:upto], LOG)
        assert jobs.keep_compacted(log, path)
        assert view(topics.compacted_table(spark, path)) == view(topics.compacted_view(log))
    # A call without news reads nothing new.
    assert topics.newer_records(spark.createDataFrame(rows, LOG), path).count() == 0


def test_only_what_is_new_is_merged_and_only_its_buckets(spark, tmp_path):
    path, rows = str(tmp_path / "t"), made_log(spark, 4)
    jobs.keep_compacted(spark.createDataFrame(rows, LOG), path)
    last = max(r[3] for r in rows if r[0] == "a")
    grown = spark.createDataFrame([*rows, ("a", "k1", "new", last + 1)], LOG)
    assert [tuple(r) for r in topics.newer_records(grown, path).collect()] == [("a", "k1", "new", last + 1)]
    jobs.keep_compacted(grown, path)
    assert len(list((tmp_path / "t" / "batch=1").glob("bucket=*"))) == 1
    assert view(topics.compacted_table(spark, path)) == view(topics.compacted_view(grown))


def test_a_record_that_comes_again_does_not_revive_its_key(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", "k", "v", 1), ("a", "k", None, 2), ("a", "x", "v", 3), ("a", "n", None, 3)], LOG)
    topics.compact_batch(first, path, 0)
    topics.compact_batch(first.filter("value is not null"), path, 1)
    assert view(topics.compacted_table(spark, path)) == [("a", "x", "v", 3)]
    # The same batch again changes nothing, not even with other rows.
    assert not topics.compact_batch(first.withColumn("offset", F.col("offset") + 9), path, 1)


def test_no_records(spark, tmp_path):
    path = str(tmp_path / "t")
    assert topics.compacted_table(spark, path).count() == 0
    assert jobs.keep_compacted(spark.createDataFrame([], LOG), path)
    assert topics.compacted_table(spark, path).columns == ["topic", "key", "value", "offset"]
    assert versions.applied(spark, path) == 0
