import json
import time

import pandas as pd
import pytest
from helpers import call, full_session, reading, records
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.operators import lines, running, sessions, topics
from voltlane.plans import jobs
from voltlane.sources import logs, messages
from voltlane.sources.history import read_history
from voltlane.streaming import job, lifecycle
from voltlane.streaming.pairing import match_stream


@pytest.fixture(autouse=True)
def rocksdb(spark):
    job.use_rocksdb(spark)


def feed(spark, folder, calls, first=0):
    rows = records(spark, calls).withColumn("offset", F.col("offset") + first)
    rows.coalesce(1).write.mode("append").parquet(folder)


def typed_stream(spark, folder):
    return jobs.typed_sessions(messages.read_messages_stream(spark, folder, "parquet"))


def live(spark, out):
    return topics.active_state_from(spark.read.schema(S.MESSAGE_LOG).parquet(out + "/live"))


PARTS = [
    full_session("a", "1")[:3] + full_session("b", "2")[:1],
    full_session("b", "2")[1:3] + full_session("a", "1")[3:],
    full_session("c", "3") + [("a", call("MeterValues", transactionId="1", meterValue=[
        reading("2025-03-04T08:44:00.000Z", power=50)]))],
]


def test_restarted_stream_equals_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, part in enumerate(PARTS):
        feed(spark, source, part, i * 100)
        job.start_sessions(typed_stream(spark, source), job.file_sinks(out), out + "/cp", availableNow=True).awaitTermination()
    batch = jobs.typed_sessions(messages.read_messages_batch(spark, source, "parquet"))
    want = sessions.completed_sessions(batch)
    got = read_history(spark, out + "/history")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    states = live(spark, out).select("sessionId", "status", "duration", "energyConsumedSoFar", "runningCount")
    assert states.collect() == running.running_state(batch).select(*states.columns).collect()
    assert [r.sessionId for r in states.collect()] == ["b_2"]


def test_lifecycle_turns_late_messages_away(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, part in enumerate(PARTS):
        feed(spark, source, part, i * 100)
        job.start_lifecycle(typed_stream(spark, source), job.file_sinks(out), out + "/cp", availableNow=True).awaitTermination()
    done = read_history(spark, out + "/history")
    without_late = jobs.typed_sessions(messages.read_messages_batch(spark, source, "parquet")).filter(
        "NOT (chargerId = 'a' AND coalesce(power, 0) = 50)"
    )
    want = sessions.completed_sessions(without_late)
    assert done.exceptAll(want).count() == 0 and want.exceptAll(done).count() == 0
    late = spark.read.parquet(out + "/late").select("key", F.get_json_object("value", "$.value.power").alias("power"))
    assert [(r.key, r.power) for r in late.collect()] == [("a_1", "50.0")]
    assert [r.sessionId for r in live(spark, out).collect()] == ["b_2"]
    raw = spark.read.parquet(out + "/live").filter(F.col("topic") == S.ACTIVE_RAW_TOPIC)
    assert raw.filter("value is not null").count() == 11
    assert {r.key for r in topics.after_last_tombstone(raw).collect()} == {"b_2"}


def test_lifecycle_forgets_idle_and_closed_sessions(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    feed(spark, source, PARTS[0] + full_session("z", "9"))
    query = job.start_lifecycle(
        typed_stream(spark, source), job.file_sinks(out), out + "/cp", closed_ms=1, idle_ms=1, processingTime="1 second"
    )
    try:
        for _ in range(120):
            time.sleep(1)
            progress = query.recentProgress
            if len(progress) > 1 and progress[-1]["stateOperators"][0]["numRowsTotal"] == 0:
                break
        else:
            pytest.fail("state was not dropped")
    finally:
        query.stop()
    assert live(spark, out).count() == 0
    assert [r.sessionId for r in read_history(spark, out + "/history").collect()] == ["z_9"]
    idle = spark.read.parquet(out + "/expired").select("sessionId", "eventCount").collect()
    assert sorted(map(tuple, idle)) == [("a_1", 3), ("b_2", 1)]


def test_lifecycle_passes_messages_as_one_column(spark, tmp_path):
    """Each column of a session's few rows is converted by itself, which took most of the time."""
    feed(spark, str(tmp_path / "in"), PARTS[0])
    plan = lifecycle.session_lifecycle(typed_stream(spark, str(tmp_path / "in")))._jdf.queryExecution().analyzed()
    assert "FlatMapGroupsInPandasWithState" in plan.nodeName() and plan.child().output().size() == 2


def test_lifecycle_leaves_out_numbers_that_are_none_and_does_not_put_off_its_timer():
    message = {"offset": 3, "chargerId": "c", "transactionId": "t", "action": S.METER, "eventTime": "2025-03-04T08:15:00.250000",
               "isStop": False, "value": "{}"}
    texts = [json.dumps(message | {"power": p, "soc": 5}) for p in ("NaN", 2.5)]
    chunk = pd.DataFrame({"sessionId": ["c_t"] * 2, "message": texts})
    summary = lifecycle._summary(lifecycle._columns(chunk))
    assert (summary["powerSum"], summary["powerCount"], summary["voltageCount"], summary["socStart"]) == (2.5, 1, 0, 5.0)
    assert summary["startTime"].isoformat() == "2025-03-04T08:15:00.250000" and summary["endTime"] is None

    class Held:
        hasTimedOut, exists, oldTimeoutTimestamp, waits = False, True, 1_000, []
        get = tuple(c == "closed" or None for c in lifecycle._FIELDS)
        getCurrentProcessingTimeMs = staticmethod(lambda: 400)
        setTimeoutDuration = waits.append

    out = list(lifecycle.SessionLifecycle(5_000, 9_000)(("c_t",), iter([chunk]), Held()))
    assert [f["kind"].tolist() for f in out] == [["late", "late"]] and Held.waits == [600]


def test_pairs_of_a_live_log(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    ddl = "line string, arrival timestamp, ord long"

    def arrive(*rows):
        df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "line string, arrival string, ord long")
        df.withColumn("arrival", F.col("arrival").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
        parsed = lines.parse_lines(spark.readStream.schema(ddl).parquet(source))
        writer = match_stream(parsed, "10 minutes").writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", out + "-cp").trigger(availableNow=True).start().awaitTermination()

    arrive(('c : [2,"1","A",{}]', "2025-01-01 10:00:00"), ('c : [2,"2","A",{}]', "2025-01-01 10:00:00"),
           ('c : [2,"2","B",{}]', "2025-01-01 10:00:01"))
    arrive(('c : [3,"1",{}]', "2025-01-01 10:05:00"), ('c : [3,"9",{}]', "2025-01-01 10:05:00"))
    # Later calls move the watermark on.
    arrive(('c : [2,"x","A",{}]', "2025-01-01 12:00:00"), ("c : no call", "2025-01-01 12:00:00"))
    arrive(('c : [2,"x2","A",{}]', "2025-01-01 12:00:01"))
    rows = spark.read.parquet(out).collect()
    got = sorted((r.uniqueId or "", r.status) for r in rows)
    assert got == [("", "reject"), ("1", "pair"), ("2", "unpaired_request"), ("9", "unpaired_response")]
    assert [r.request for r in rows if r.uniqueId == "2"] == ['[2,"2","B",{}]']  # the last one counts
    letters = topics.to_dead_letter(spark.read.parquet(out)).select(F.get_json_object("value", "$.reason").alias("r"))
    assert sorted(r.r for r in letters.collect()) == [
        "JSON/ast parsing failed", "unpaired_request_no_response", "unpaired_response_no_request"]


def test_log_files_arrive_as_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('# x\n\nc : [2,"1","A",{}]\n')
    parsed = lines.parse_lines(logs.read_log_stream(spark, str(tmp_path / "in")))
    out = str(tmp_path / "out")
    writer = parsed.select("uniqueId", "kind", "arrival").writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", out + "-cp").trigger(availableNow=True).start().awaitTermination()
    assert [(r.uniqueId, r.kind) for r in spark.read.parquet(out).collect()] == [("1", "request")]


def test_live_log_alone(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    feed(spark, source, full_session("a", "1"))
    job.start_live_log(typed_stream(spark, source), job.file_sinks(out), out + "/cp", availableNow=True).awaitTermination()
    assert [r.offset for r in spark.read.parquet(out + "/live").orderBy("offset").collect()] == [0, 1, 2, 3]


def test_merge_sink_replaces_known_sessions(spark, tmp_path):
    staging, table = str(tmp_path / "staging"), {}

    def merge(spark, batch_id):  # what the statement does in a database
        table.update({r.sessionId: r.duration for r in spark.read.parquet(staging).collect()})

    done = sessions.completed_sessions(jobs.typed_sessions(records(spark, full_session("a", "1"))))
    write = job.merge_sink(merge, order="duration", format="parquet", path=staging)
    write(done, 0)
    later = done.withColumn("duration", F.lit(9999))
    write(done.unionByName(later).unionByName(done.withColumn("sessionId", F.lit("new"))), 1)
    assert table == {"a_1": 9999, "new": 1200}


def test_a_session_that_goes_on_after_its_stop_is_replaced(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    stop = ("a", call("StopTransaction", transactionId="1", timestamp="2025-03-04T09:15:00.000Z"))
    for i, part in enumerate((full_session("a", "1"), [stop])):
        feed(spark, source, part, i * 100)
        job.start_sessions(typed_stream(spark, source), job.file_sinks(out), out + "/cp", availableNow=True).awaitTermination()
    assert [(r.sessionId, r.duration) for r in read_history(spark, out + "/history").collect()] == [("a_1", 3600)]


def test_tombstones_are_written_after_all_the_rest(spark, tmp_path):
    source, order = str(tmp_path / "in"), []
    feed(spark, source, full_session("a", "1") + full_session("b", "2")[:2])
    names = ("live", "history", "late", "expired", "tombstones")
    sinks = {n: lambda df, i, n=n: order.append((i, n, df.count())) for n in names}
    for start in (job.start_lifecycle, job.start_sessions):
        order.clear()
        start(typed_stream(spark, source), sinks, str(tmp_path / start.__name__), availableNow=True).awaitTermination()
        assert sum(count for _, n, count in order if n == "tombstones") == 2
        for batch in {i for i, _, _ in order}:
            written = [n for i, n, _ in order if i == batch]
            assert written[-1] == "tombstones" and written.count("tombstones") == 1


def test_a_continuous_run_bounds_its_state(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(job.lifecycle, "session_lifecycle", lambda m, closed, idle: seen.append((closed, idle)) or 1 / 0)
    for trigger in ({"availableNow": True}, {"processingTime": "1 second"}, {}):
        with pytest.raises(ZeroDivisionError):
            job.start_lifecycle(None, {}, "x", **trigger)
    assert seen == [(None, None), (job.CLOSED_MS, job.IDLE_MS), (job.CLOSED_MS, job.IDLE_MS)]
