import json
from datetime import datetime

import pytest
from helpers import call, full_session, reading, records
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.operators import quality, running, sessions, tables, topics
from voltlane.plans import jobs, views
from voltlane.sources.history import read_history

LOG = "topic string, key string, value string, offset bigint"


@pytest.fixture
def keyed(spark):
    rows = [
        ("t", "a", "1", 0), ("t", "a", "2", 1), ("t", "b", "1", 2), ("t", "a", None, 3), ("t", "b", "2", 4),
        ("t", "c", "1", 5), ("t", "c", None, 6), ("t", "c", "2", 7), ("t", "c", "3", 8), ("u", "a", "9", 9),
    ]
    return spark.createDataFrame(rows, LOG)


def test_compacted_view(keyed):
    got = sorted((r.topic, r.key, r.value) for r in topics.compacted_view(keyed).collect())
    assert got == [("t", "b", "2"), ("t", "c", "3"), ("u", "a", "9")]


def test_records_after_the_last_tombstone(keyed):
    got = topics.after_last_tombstone(keyed, rows_per_block=2).collect()
    assert sorted(r.offset for r in got) == [2, 4, 7, 8, 9]


def test_tombstones_go_to_both_topics_once(spark):
    stops = jobs.typed_sessions(records(spark, full_session() + full_session())).filter("isStop")
    got = topics.to_tombstones(stops).collect()
    assert sorted((r.topic, r.key, r.value) for r in got) == [
        ("ocpp.active", "pole-k_t77", None),
        ("ocpp.active.raw", "pole-k_t77", None),
    ]


def test_live_log_values(spark):
    extra = call("MeterValues", transactionId="z", meterValue=[reading("2025-01-01T10:00:00Z", power=0)])
    typed = jobs.typed_sessions(records(spark, full_session()[:1] + [extra]))
    start, meter = [json.loads(r.value) for r in topics.to_active_raw(typed).orderBy("offset").collect()]
    assert start == {
        "stationId": "pole-k", "timestamp": "2025-03-04T08:15:00.000+00:00", "action": "StartTransaction",
        "value": {"transactionId": "t77", "meterStart": 41200, "idTag": "card-amber", "connectorId": 2},
    }
    assert meter["value"] == {"power": 0.0, "soc": None, "voltage": None}


def test_live_state_value(spark):
    typed = jobs.typed_sessions(records(spark, full_session()[:3]))
    record = topics.to_active_state(running.running_state(typed)).first()
    assert record.key == "pole-k_t77"
    assert json.loads(record.value) == {
        "sessionId": "pole-k_t77", "stationId": "pole-k", "transactionId": "t77", "status": "active",
        "startTime": "2025-03-04T08:15:00+00:00", "lastSeen": "2025-03-04T08:23:00+00:00", "duration": 480,
        "energyConsumedSoFar": 1.5, "runningCount": 2,
    }


def test_transaction_id_from_the_response(spark):
    matched = spark.createDataFrame(
        [("u", "c", '[2,"u","StartTransaction",{"meterStart":5,"timestamp":"2025-01-01T10:00:00Z"}]',
          '[3,"u",{"transactionId":77}]', "pair")],
        "uniqueId string, chargerId string, request string, response string, status string",
    )
    for recover, expected in ((False, []), (True, ["c_77"])):
        log = topics.to_message_log(matched, recover).withColumn("offset", F.lit(0))
        assert [r.sessionId for r in jobs.typed_sessions(log).collect()] == expected


# Tables


@pytest.fixture(scope="module")
def history(spark):
    calls = full_session("a", "1") + full_session("b", "2") + full_session("c", "3")
    return sessions.completed_sessions(jobs.typed_sessions(records(spark, calls))).persist()


def test_upsert(spark, history):
    update = history.filter("stationId = 'a'").withColumn("duration", F.lit(1))
    new = update.withColumn("sessionId", F.lit("new"))
    both = update.unionByName(new)
    replaced = {r.sessionId: r.duration for r in tables.upsert(history, both).collect()}
    skipped = {r.sessionId: r.duration for r in tables.upsert(history, both, on_conflict="skip").collect()}
    assert replaced == {"a_1": 1, "b_2": 1200, "c_3": 1200, "new": 1}
    assert skipped == {"a_1": 1200, "b_2": 1200, "c_3": 1200, "new": 1}


def test_update_and_delete(history):
    hit = F.col("stationId") == "a"
    updated = tables.update_rows(history, hit, {"idTag": F.lit("x"), "eventCount": F.col("eventCount") + 1})
    assert sorted((r.idTag, r.eventCount) for r in updated.collect()) == [("card-amber", 5), ("card-amber", 5), ("x", 6)]
    assert tables.delete_rows(history, hit).count() == 2
    assert tables.delete_rows(history, F.col("idTag") == None).count() == 3  # noqa: E711
    assert tables.delete_keys(history, history.filter(hit), "sessionId").count() == 2


def test_insert_defaults(spark):
    minimal = spark.createDataFrame([("s", "c", "t")], "sessionId string, stationId string, transactionId string")
    row = tables.aligned(minimal).first()
    assert row.eventCount == 0 and row.endTime is None and list(row.asDict()) == S.columns(S.HISTORY)


def test_batches_are_idempotent_and_newest_wins(spark, history, tmp_path):
    path = str(tmp_path / "h")
    for _ in range(2):
        tables.write_batch(history, path, 0)
    tables.write_batch(history.filter("stationId = 'a'").withColumn("duration", F.lit(7)), path, 1)
    assert {r.sessionId: r.duration for r in read_history(spark, path).collect()} == {"a_1": 7, "b_2": 1200, "c_3": 1200}
    tables.compact_table(read_history(spark, path), str(tmp_path / "d"))
    daily = spark.read.parquet(str(tmp_path / "d"))
    assert daily.count() == 3 and "day" in daily.columns


def test_plain_and_daily_tables_are_read_as_they_are(spark, history, tmp_path):
    history.write.parquet(str(tmp_path / "plain"))
    assert read_history(spark, str(tmp_path / "plain")).exceptAll(history).count() == 0
    for batch in (0, 1):
        tables.write_batch(history.withColumn("duration", F.lit(batch)), str(tmp_path / "batches"), batch)
    tables.compact_batches(spark, str(tmp_path / "batches"), str(tmp_path / "daily"))
    daily = read_history(spark, str(tmp_path / "daily"))
    assert [(r.duration, str(r.day)) for r in daily.collect()] == [(1, "2025-03-04")] * 3
    plan = views.recent(daily, F.lit(datetime(2025, 3, 6)), 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    (tmp_path / "none").mkdir()
    assert read_history(spark, str(tmp_path / "none")).count() == 0
    spark.range(1).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="no session table"):
        read_history(spark, str(tmp_path / "other"))


def test_repeated_updates_leave_one_row_per_key(history):
    update = history.filter("stationId = 'a'")
    twice = update.withColumn("duration", F.lit(1)).unionByName(update.withColumn("duration", F.lit(2)))
    for options, expected in (({"order": "duration"}, 2), ({"order": F.col("duration") * -1}, 1), ({}, 2)):
        rows = tables.upsert(history, twice, **options).collect()
        assert sorted((r.sessionId, r.duration) for r in rows) == [("a_1", expected), ("b_2", 1200), ("c_3", 1200)]


def test_merge_statement():
    assert tables.merge_statement("done", "incoming", ["sessionId", "duration"]) == (
        "MERGE INTO done t USING incoming s ON t.sessionId = s.sessionId WHEN MATCHED THEN UPDATE SET "
        "duration = s.duration WHEN NOT MATCHED THEN INSERT (sessionId, duration) VALUES (s.sessionId, s.duration)"
    )


@pytest.mark.parametrize("format", ["json", "csv", "parquet"])
def test_export(spark, history, tmp_path, format):
    path = str(tmp_path / format)
    tables.export(history, path, format)
    assert spark.read.format(format).load(path).count() == 3
    if format == "json":
        row = json.loads(spark.read.text(path).first().value)
        assert row["totalEnergyConsumed"] == {"value": 5.0, "unit": "kWh"}


def test_json_rows_keep_nulls(history):
    row = json.loads(tables.to_json_rows(history.withColumn("idTag", F.lit(None).cast("string"))).first().json)
    assert row["idTag"] is None and row["totalEnergyConsumed"]["unit"] == "kWh"


def test_quality_checks_find_what_is_wrong(history):
    assert quality.required_nulls(history).first().asDict() == {c: 0 for c in quality.REQUIRED}
    assert quality.meter_order(history).count() == 0
    assert quality.meter_order(history.withColumn("meterStop", F.lit(1))).count() == 3
    assert quality.energy_mismatch(history).count() == 0
    assert quality.energy_mismatch(history.withColumn("avgPower", F.lit(99.0))).count() == 3
    assert quality.duration_mismatch(history).count() == 0
    assert quality.duration_mismatch(history.withColumn("duration", F.lit(1202))).count() == 3
    assert quality.not_completed(history).count() == 0
    assert quality.not_completed(history.withColumn("status", F.lit(None).cast("string"))).count() == 3
    assert quality.active_and_completed(history, history).count() == 3


def test_views(spark, history):
    as_of = F.lit(datetime(2025, 3, 6))
    assert [r.sessions for r in views.energy_by_station(history, as_of, 1).collect()] == []
    assert {r.stationId: r.totalEnergy for r in views.energy_by_station(history, as_of, 30).collect()} == {
        "a": 5.0, "b": 5.0, "c": 5.0}
    assert views.termination_stats(history).first().sessions == 3
    assert views.station_sessions(history, "a", as_of).count() == 1
    assert views.sessions_by(history, "month", ()).first().sessions == 3
    assert views.lookup(history, sessionId="b_2").first().stationId == "b"
    assert [r.sessionId for r in views.newest_sessions(history, 2).collect()] == ["a_1", "b_2"]


def test_sql_views(spark, history):
    live = running.running_state(jobs.typed_sessions(records(spark, full_session("d", "4")[:2])))
    views.register_views(history, live)
    counts = spark.sql("SELECT status, count(*) AS n FROM sessions GROUP BY status").collect()
    assert {r.status: r.n for r in counts} == {"completed": 3, "active": 1}
