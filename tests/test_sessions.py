import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from helpers import call, full_session, reading, records
from pyspark.sql import functions as F

from voltlane.operators import epochs, filters, running, sessions, tracker
from voltlane.plans import jobs, views
from voltlane.sources import messages as M


def typed(spark, calls, **kw):
    return jobs.typed_sessions(records(spark, calls, **kw))


def test_completed_session(spark):
    row = sessions.completed_sessions(typed(spark, full_session())).collect()
    assert len(row) == 1
    got = row[0].asDict()
    assert got == {
        "sessionId": "pole-k_t77", "stationId": "pole-k", "transactionId": "t77", "status": "completed",
        "startTime": datetime(2025, 3, 4, 8, 15), "endTime": datetime(2025, 3, 4, 8, 35), "duration": 1200,
        "lastSeen": datetime(2025, 3, 4, 8, 35), "terminationReason": "Local", "totalEnergyConsumed": 5.0,
        "avgPower": 15.0, "maxPower": 22.5, "idTag": "card-amber", "connectorId": 2, "meterStart": 41200,
        "meterStop": 41950, "socStart": 43.0, "socEnd": 49.0, "voltageAvg": 233.0, "eventCount": 5,
    }


def test_arrival_order_does_not_matter(spark):
    calls = full_session() + full_session("charger2", "x")
    random.Random(3).shuffle(calls)
    one = sessions.completed_sessions(typed(spark, full_session() + full_session("charger2", "x")))
    assert one.exceptAll(sessions.completed_sessions(typed(spark, calls))).count() == 0


def test_active_session_is_not_in_history(spark):
    messages = typed(spark, full_session()[:3])
    state = running.running_state(messages).collect()
    assert sessions.completed_sessions(messages).count() == 0
    assert [(r.status, r.duration, r.runningCount) for r in state] == [("active", 480, 2)]
    assert state[0].energyConsumedSoFar == round(11.25 * 480 / 3600, 4)


def test_pending_until_the_first_reading(spark):
    state = running.running_state(typed(spark, full_session()[:1])).first()
    assert (state.status, state.runningCount, state.energyConsumedSoFar) == ("pending", 0, 0.0)


def test_same_transaction_on_two_chargers(spark):
    messages = typed(spark, full_session("a", "1") + full_session("b", "1"))
    assert sorted(r.sessionId for r in sessions.completed_sessions(messages).collect()) == ["a_1", "b_1"]


def test_remote_stop_ends_a_session_by_default(spark):
    calls = full_session()[:2] + [
        ("pole-k", call("RemoteStopTransaction", transactionId="t77", timestamp="2025-03-04T08:24:00.000Z"))
    ]
    messages = typed(spark, calls)
    assert sessions.completed_sessions(messages).first().duration == 540
    assert sessions.completed_sessions(messages, stop_actions=["StopTransaction"]).count() == 0


def test_session_status(spark):
    calls = full_session("a", "1") + full_session("b", "2")[:3] + full_session("c", "3")[:1]
    found = {r.stationId: r for r in sessions.session_status(typed(spark, calls)).collect()}
    assert (found["a"].status, found["a"].terminationReason) == ("ended", "Local")
    assert (found["b"].status, found["b"].terminationReason, found["b"].endTime) == ("active", None, None)
    assert found["c"].status is None


def test_live_and_completed_never_overlap(spark):
    messages = typed(spark, full_session("a", "1") + full_session("b", "2")[:3])
    live, done = running.running_state(messages), sessions.completed_sessions(messages)
    both = views.bridge(live, done).collect()
    assert sorted((r.sessionId, r.status) for r in both) == [("a_1", "completed"), ("b_2", "active")]


# A session that holds most rows, in many small blocks, against plain Python.


@pytest.fixture(scope="module")
def crowded(spark):
    rng = random.Random(7)
    start = datetime(2025, 1, 1)
    rows = []
    for offset in range(3000):
        session = "hot" if offset % 3 == 0 else f"s{rng.randrange(40)}"
        at = start + timedelta(seconds=rng.randrange(100_000))
        is_stop = rng.random() < 0.02
        action = "StopTransaction" if is_stop else rng.choice(["MeterValues", "MeterValues", "StartTransaction"])
        power = float(rng.randrange(50)) if action == "MeterValues" and rng.random() < 0.8 else None
        rows.append(("c", session, f"c_{session}", offset, at, power, action, is_stop))
    ddl = ("chargerId string, transactionId string, sessionId string, offset bigint, eventTime timestamp, "
           "power double, action string, isStop boolean")  # fmt: skip
    return rows, spark.createDataFrame(rows, ddl)


def replayed(rows, order):
    seen, result = defaultdict(list), {}
    for row in sorted((r for r in rows if not r[7]), key=order):
        seen[row[2]].append(row)
        so_far = seen[row[2]]
        times = [r[4] for r in so_far]
        powers = [r[5] for r in so_far if r[5] is not None]
        count = sum(r[6] == "MeterValues" for r in so_far)
        seconds = int((max(times) - min(times)).total_seconds())
        energy = sum(powers) / len(powers) * seconds / 3600 if powers else 0.0
        result[row[3]] = (min(times), max(times), seconds, round(energy, 3), count)
    return result


@pytest.mark.parametrize("order,key", [("arrival", lambda r: r[3]), ("event_time", lambda r: (r[4], r[3]))])
def test_replay_of_a_crowded_session(crowded, order, key):
    rows, df = crowded
    state = running.running_state_replay(df, order=order, rows_per_block=100).collect()
    got = {
        r.offset: (r.startTime, r.lastSeen, r.duration, round(r.energyConsumedSoFar, 3), r.runningCount) for r in state
    }
    want = replayed(rows, key)
    assert got.keys() == want.keys()
    for offset, expected in want.items():
        assert got[offset][:3] == expected[:3] and got[offset][4] == expected[4]
        assert got[offset][3] == pytest.approx(expected[3], abs=0.0015)


def test_epochs_of_a_crowded_session(crowded):
    rows, df = crowded
    got = {r.offset: r.epoch for r in epochs.with_epoch(df, ["transactionId"], F.col("isStop"), rows_per_block=100).collect()}
    stops, want = defaultdict(int), {}
    for row in rows:
        want[row[3]] = stops[row[1]]
        stops[row[1]] += row[7]
    assert got == want


def test_first_event_time_of_a_crowded_session(crowded):
    rows, df = crowded
    got = {r.offset: r.sessionStart for r in running.with_first_event_time(df, rows_per_block=100).collect()}
    first = {}
    for row in rows:
        first[row[2]] = min(first.get(row[2], row[4]), row[4])
    assert got == {row[3]: first[row[2]] for row in rows}


def test_trapezoid_energy_of_a_crowded_session(crowded):
    rows, df = crowded
    got = {r.sessionId: (r.energy, r.readings) for r in sessions.trapezoid_energy(df, blocks=16).collect()}
    series = defaultdict(list)
    for row in rows:
        if row[5] is not None:
            series[row[2]].append((row[4], row[3], row[5]))
    for session, points in series.items():
        points.sort()
        area = sum((b[0] - a[0]).total_seconds() * (a[2] + b[2]) / 2 for a, b in zip(points, points[1:]))
        assert got[session][0] == pytest.approx(area / 3600, abs=0.002) and got[session][1] == len(points)


def test_no_window_runs_over_a_whole_session(crowded):
    plan = running.running_state_replay(crowded[1])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # Rows are windowed by (session, block); the only window by session alone reads block summaries.
    assert len(windows) == 3 and sum("block#" in w.split("], [")[1] for w in windows) == 1


# The older consumer's sessions.


def payloads(spark, calls):
    return M.decode_payloads(records(spark, calls))


def test_tracker_counts_every_sample(spark):
    at = ["2025-01-01T10:00:00Z", "2025-01-01T10:02:00Z"]
    calls = [
        call("MeterValues", transactionId=1, meterValue=[reading(at[0], power=22.5), reading(at[1], power=25.0)]),
        call("StopTransaction", transactionId=1, timestamp="2025-01-01T10:02:00Z", reason="Local"),
    ]
    row = tracker.track_sessions(payloads(spark, calls)).first()
    assert (row.duration, row.totalEnergyConsumed, row.eventCount) == (120, 0.792, 2)
    assert row.sessionId == "charger1_2025-01-01T10:00:00+00:00" and row.status == "ended"


def test_tracker_without_power_or_start(spark):
    calls = [
        call("MeterValues", transactionId=1, meterValue=[reading("2025-01-01T10:00:00Z", voltage=230)]),
        call("StopTransaction", transactionId=1, timestamp="2025-01-01T10:02:00Z"),
        call("StopTransaction", transactionId=2, timestamp="2025-01-01T10:02:00Z"),
    ]
    rows = sorted(tracker.track_sessions(payloads(spark, calls)).collect(), key=lambda r: r.sessionId)
    assert [(r.duration, r.totalEnergyConsumed) for r in rows] == [(None, None), (None, None)]
    assert rows[1].sessionId == "charger1_unknown"


def test_tracker_opens_a_new_session_after_the_stop(spark):
    one = lambda t, p: call("MeterValues", transactionId=1, meterValue=[reading(t, power=p)])
    stop = lambda t: call("StopTransaction", transactionId=1, timestamp=t)
    calls = [
        one("2025-01-01T10:00:00Z", 10), stop("2025-01-01T11:00:00Z"),
        one("2025-01-01T12:00:00Z", 20), one("2025-01-01T11:30:00Z", 20), stop("2025-01-01T13:00:00Z"),
        one("2025-01-01T14:00:00Z", 30),
    ]
    closed = tracker.track_sessions(payloads(spark, calls))
    assert sorted((r.duration, r.totalEnergyConsumed, r.eventCount) for r in closed.collect()) == [
        (3600, 10.0, 2),
        (5400, 30.0, 3),
    ]
    still_open = tracker.track_sessions(payloads(spark, calls), include_open=True).filter("status is null")
    assert [r.startTime.hour for r in still_open.collect()] == [14]


def test_tracker_end_is_the_last_processed_reading(spark):
    calls = [
        call("MeterValues", transactionId=1, meterValue=[reading("2025-01-01T12:00:00Z", power=20)]),
        call("MeterValues", transactionId=1, meterValue=[reading("2025-01-01T11:30:00Z", power=20)]),
    ]
    row = tracker.track_sessions(payloads(spark, calls), include_open=True).first()
    assert (row.startTime.hour, row.startTime.minute, row.endTime.hour, row.duration) == (11, 30, 11, 0)


def test_tracker_key_by_transaction_alone_mixes_chargers(spark):
    calls = [
        ("a", call("MeterValues", transactionId=1, meterValue=[reading("2025-01-01T10:00:00Z", power=1)])),
        ("b", call("StopTransaction", transactionId=1, timestamp="2025-01-01T11:00:00Z")),
    ]
    assert tracker.track_sessions(payloads(spark, calls), key=("transactionId",)).first().stationId == "b"
    assert tracker.track_sessions(payloads(spark, calls)).filter("startTime is null").count() == 1


def test_filters(spark):
    messages = M.decode_messages(records(spark, full_session() + [call("Heartbeat"), call("MeterValues")]))
    kept = filters.session_messages(messages)
    assert kept.count() == 5 and filters.stop_messages(kept).count() == 1 and filters.active_messages(kept).count() == 4
