"""The lifecycle with its sessions in a keyed table, against the one with a state store and against a batch."""

from datetime import timedelta

import pytest
from helpers import call, full_session, reading, records
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.operators import sessions, topics, versions
from voltlane.plans import jobs
from voltlane.sources import messages
from voltlane.sources.history import read_history
from voltlane.streaming import batches, job

AFTER = ("a", call("MeterValues", transactionId="1", meterValue=[reading("2025-03-04T08:44:00.000Z", power=50)]))
PARTS = [
    full_session("a", "1")[:3] + full_session("b", "2")[:1],
    full_session("b", "2")[1:3] + full_session("a", "1")[3:],
    full_session("c", "3") + [AFTER],
]


def typed(spark, calls, first=0):
    return jobs.typed_sessions(records(spark, calls).withColumn("offset", F.col("offset") + first))


def run(spark, folder, parts, **options):
    options = {"closed_ms": None, "idle_ms": None, "buckets": 4} | options
    sinks = job.file_sinks(folder)
    for i, part in enumerate(parts):
        batches.run_batch(typed(spark, part, i * 100), sinks, folder + "/state", i, **options)


def test_equals_the_batch_and_turns_late_messages_away(spark, tmp_path):
    out = str(tmp_path)
    run(spark, out, PARTS)
    everything = typed(spark, PARTS[0]).unionByName(typed(spark, PARTS[1], 100)).unionByName(typed(spark, PARTS[2][:-1], 200))
    want, got = sessions.completed_sessions(everything), read_history(spark, out + "/history")
    assert got.count() == 2 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    late = spark.read.parquet(out + "/late").select("key", F.get_json_object("value", "$.value.power").alias("power"))
    assert [tuple(r) for r in late.collect()] == [("a_1", "50.0")]
    log = spark.read.schema(S.MESSAGE_LOG).parquet(out + "/live")
    assert [r.sessionId for r in topics.active_state_from(log).collect()] == ["b_2"]
    raw = log.filter(F.col("topic") == S.ACTIVE_RAW_TOPIC)
    assert raw.filter("value is not null").count() == 11
    assert {r.key for r in topics.after_last_tombstone(raw).collect()} == {"b_2"}


def test_the_stream_equals_the_one_with_a_state_store(spark, tmp_path):
    job.use_rocksdb(spark)
    source = str(tmp_path / "in")
    one, other = str(tmp_path / "one"), str(tmp_path / "other")
    for i, part in enumerate(PARTS[:2]):
        records(spark, part).withColumn("offset", F.col("offset") + i * 100).coalesce(1).write.mode("append").parquet(source)
        read = lambda: jobs.typed_sessions(messages.read_messages_stream(spark, source, "parquet"))
        job.start_lifecycle(read(), job.file_sinks(one), one + "/cp", availableNow=True).awaitTermination()
        job.start_lifecycle_in_batches(
            read(), job.file_sinks(other), other + "/state", other + "/cp", buckets=4, availableNow=True
        ).awaitTermination()
    for name in ("history", "late", "live/kind=records", "live/kind=tombstones"):
        a, b = (spark.read.parquet(f"{out}/{name}").drop("kind") for out in (one, other))
        assert a.count() > 0 or name == "late"
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_closed_and_silent_sessions_are_forgotten(spark, tmp_path):
    out = str(tmp_path)
    now = lambda hours: F.lit("2025-03-05 00:00:00").cast("timestamp") + F.make_dt_interval(hours=F.lit(hours))
    hour = int(timedelta(hours=1).total_seconds() * 1000)
    sinks = job.file_sinks(out)
    limits = {"closed_ms": 2 * hour, "idle_ms": 5 * hour, "buckets": 2}
    state = lambda: {r.sessionId for r in versions.read_versions(spark, out + "/state").collect()}
    batches.run_batch(typed(spark, PARTS[0] + full_session("z", "9")), sinks, out + "/state", 0, now=now(0), **limits)
    assert state() == {"a_1", "b_2", "z_9"}
    none = typed(spark, PARTS[0]).limit(0)
    for batch, hours in ((1, 1), (2, 1), (3, 3), (4, 3)):
        batches.run_batch(none, sinks, out + "/state", batch, now=now(hours), **limits)
    assert state() == {"a_1", "b_2"}  # the closed one is gone
    for batch in (5, 6):
        batches.run_batch(none, sinks, out + "/state", batch, now=now(6), **limits)
    assert state() == set()
    idle = spark.read.parquet(out + "/expired").select("sessionId", "eventCount").collect()
    assert sorted(map(tuple, idle)) == [("a_1", 3), ("b_2", 1)]
    assert topics.active_state_from(spark.read.schema(S.MESSAGE_LOG).parquet(out + "/live")).count() == 0
    assert [r.sessionId for r in read_history(spark, out + "/history").collect()] == ["z_9"]


@pytest.mark.parametrize("lost", ["history", "tombstones", "state"])
def test_a_batch_that_broke_off_is_repeated(spark, tmp_path, monkeypatch, lost):
    out, whole = str(tmp_path / "out"), str(tmp_path / "whole")
    run(spark, whole, PARTS)
    run(spark, out, PARTS[:1])
    with monkeypatch.context() as m:

        def fail(*args, **kw):
            raise OSError("lost")

        sinks = job.file_sinks(out)
        if lost == "state":
            m.setattr(versions, "_commit", fail)
        else:
            sinks[lost] = fail
        with pytest.raises(OSError):
            batches.run_batch(typed(spark, PARTS[1], 100), sinks, out + "/state", 1, None, None, 4)
    for batch in (1, 1, 2):  # the second time after it was applied
        batches.run_batch(typed(spark, PARTS[batch], batch * 100), job.file_sinks(out), out + "/state", batch, None, None, 4)
    for name in ("history", "late", "live/kind=records", "live/kind=tombstones"):
        a, b = (spark.read.parquet(f"{folder}/{name}") for folder in (out, whole))
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())), name


def test_sums_are_combined_before_the_shuffle_and_by_hash(spark):
    plan = batches.session_sums(typed(spark, PARTS[0]))._jdf.queryExecution().executedPlan().toString()
    numbers = plan.split("Exchange")[-1]
    assert "partial_sum(" in numbers and "SortAggregate" not in numbers
