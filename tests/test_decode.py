from datetime import datetime

import pytest
from helpers import call, reading, records
from pyspark.sql import functions as F

from voltlane.functions.calls import event_time
from voltlane.sources import messages as M

AT = "2025-01-01T10:00:00Z"


def decode(spark, text, **options):
    rows = M.decode_messages(records(spark, [text]), **options).collect()
    return rows[0] if rows else None


@pytest.mark.parametrize("text", ["", "no call at all", '[2, "short"]', "5", '{"a": 1}', None])
def test_undecodable_calls_are_dropped(spark, text):
    assert decode(spark, text) is None


def test_call_without_payload(spark):
    row = decode(spark, '[2, "m", "BootNotification"]')
    assert row.action == "BootNotification" and row.transactionId is None and row.timestamp_str is None


def test_numeric_transaction_id_becomes_text(spark):
    assert decode(spark, call("StopTransaction", transactionId=123)).transactionId == "123"


def test_first_power_wins_and_bad_values_are_skipped(spark):
    values = [reading(AT, power="twelve"), reading(AT, power=1840.25), reading(AT, power=1910.0)]
    assert decode(spark, call("MeterValues", meterValue=values)).power == 1840.25
    assert decode(spark, call("MeterValues", meterValue=values[:1])).power is None
    assert decode(spark, call("MeterValues", meterValue=[reading(AT, voltage=230)])).power is None


def test_soc_and_voltage_do_not_look_further_than_the_first_sample(spark):
    row = decode(spark, call("MeterValues", meterValue=[reading(AT, soc=75, voltage=230)]))
    assert (row.soc, row.voltage) == (75.0, 230.0)
    bad_first = [reading(AT, soc="x"), reading(AT, soc=75)]
    assert decode(spark, call("MeterValues", meterValue=bad_first)).soc is None


def test_zero_stays_zero(spark):
    row = decode(spark, call("MeterValues", meterValue=[reading(AT, power=0, soc=0)]))
    assert (row.power, row.soc) == (0.0, 0.0)


def test_entry_without_samples_is_no_obstacle(spark):
    row = decode(spark, call("MeterValues", meterValue=[{"timestamp": AT}, reading(AT, power=5)]))
    assert row.power == 5.0


def test_start_and_stop_fields(spark):
    row = decode(spark, call("StartTransaction", meterStart=8800, meterStop="9125", idTag="card-jade", connectorId=3))
    assert (row.meterStart, row.meterStop, row.idTag, row.connectorId) == (8800, 9125, "card-jade", 3)
    assert decode(spark, call("StartTransaction", meterStart=10.7)).meterStart == 10
    assert decode(spark, call("StartTransaction", meterStart="10.7", connectorId="2.0")).meterStart is None
    assert decode(spark, call("StartTransaction", connectorId="2.0")).connectorId is None
    assert decode(spark, call("StartTransaction", connectorId=2.0)).connectorId == 2
    assert decode(spark, call("StartTransaction", meterStart="junk")).meterStart is None
    assert decode(spark, call("StartTransaction", meterStart=None, connectorId=[1])).connectorId is None
    assert decode(spark, call("StartTransaction", meterStart=5_000_000_000)).meterStart == 5_000_000_000


def test_timestamp_of_payload_or_first_entry(spark):
    top = decode(spark, call("StopTransaction", timestamp=AT))
    nested = decode(spark, call("MeterValues", timestamp="", meterValue=[reading(AT, power=1)]))
    assert top.timestamp_str == nested.timestamp_str == "2025-01-01T10:00:00+00:00"
    assert decode(spark, call("Other", meterValue=[reading(AT, power=1)])).timestamp_str is None


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2025-01-01T10:00:00.000+00:00", datetime(2025, 1, 1, 10)),
        ("2025-01-01T10:00:00+00:00", datetime(2025, 1, 1, 10)),
        ("2025-01-01T10:00:00.123456+05:30", datetime(2025, 1, 1, 4, 30, 0, 123456)),
        ("2025-01-01T10:00:00.5+00:00", datetime(2025, 1, 1, 10, 0, 0, 500000)),
        ("10:00:00", None),
        ("2025-01-01", None),
        ("garbage", None),
        ("20250101T100000Z", None),
    ],
)
def test_event_time(spark, text, expected):
    df = spark.createDataFrame([(text,)], "ts string")
    assert df.select(event_time(df.ts).alias("t")).first().t == expected


def test_strict_millis_takes_three_digits_only(spark):
    texts = ["2025-01-01T10:00:00.000+00:00", "2025-01-01T10:00:00+00:00", "2025-01-01T10:00:00.123456+00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "ts string")
    assert [r.t is not None for r in df.select(event_time(df.ts, True).alias("t")).collect()] == [True, False, False]


def test_units(spark):
    entry = {"timestamp": AT, "sampledValue": [{"value": "7200", "measurand": "Power.Active.Import", "unit": "W"}]}
    text = call("MeterValues", meterValue=[entry])
    assert decode(spark, text).power == 7200.0
    assert decode(spark, text, normalize_units=True).power == 7.2


def test_stop_actions(spark):
    flags = {a: decode(spark, call(a)).isStop for a in
             ("StopTransaction", "RemoteStopTransaction", "MeterValues", "StartTransaction")}
    assert flags == {"StopTransaction": True, "RemoteStopTransaction": True, "MeterValues": False,
                     "StartTransaction": False}


def test_python_literals(spark):
    text = "[2, 'u1', 'StopTransaction', {'transactionId': None, 'reason': 'it\\'s', 'ok': True}]"
    assert decode(spark, text, python_literals=False) is None
    row = decode(spark, text)
    assert (row.action, row.reason, row.transactionId) == ("StopTransaction", "it's", None)


def test_tuple_literal(spark):
    assert decode(spark, "(2, 'u1', 'Heartbeat', {})").action == "Heartbeat"


def test_session_only_keeps_escaped_actions(spark):
    escaped = '[2, "u", "Stop\\u0054ransaction", {"transactionId": "1"}]'
    pieces = "[2, 'u', 'Meter' 'Values', {'transactionId': None}]"
    hexed = "[2, 'u', '\\x4deterValues', {'transactionId': None}]"
    texts = [escaped, call("Heartbeat"), pieces, hexed]
    rows = M.decode_messages(records(spark, texts), session_only=True).collect()
    assert [r.action for r in rows] == ["StopTransaction", "MeterValues", "MeterValues"]


def test_status_of_any_spelling(spark):
    texts = ['[2, "u", "Status\\u004eotification", {"status": "Faulted"}]', "[2, 'u', 'StatusNotification', {'status': None}]"]
    assert [r.status for r in M.decode_status(records(spark, texts)).collect()] == ["Faulted", None]


def test_offsets_of_several_partitions_stay_apart(spark, tmp_path):
    rows = records(spark, [call("Heartbeat")] * 3).withColumn("offset", F.lit(0).cast("long"))
    rows.withColumn("partition", F.substring("key", 2, 1).cast("int")).write.parquet(str(tmp_path / "t"))
    read = M.read_messages_batch(spark, str(tmp_path / "t"), "parquet")
    assert sorted(r.offset for r in read.collect()) == [0, 1, 2] and "partition" not in read.columns
    rows.withColumn("partition", F.lit(M.PARTITIONS)).write.parquet(str(tmp_path / "far"))
    with pytest.raises(Exception, match="partition out of range"):
        M.read_messages_batch(spark, str(tmp_path / "far"), "parquet").collect()


def test_bad_envelope_leaves_no_row(spark):
    bad = spark.createDataFrame([("t", "k", "no json", 0, None)], "topic string, key string, value string, "
                                "offset bigint, timestamp timestamp")  # fmt: skip
    assert M.decode_envelope(bad).first().uniqueId == "k"
    assert M.decode_messages(bad).count() == 0


def test_json_is_parsed_once(spark):
    df = M.decode_messages(records(spark, [call("Heartbeat")]), session_only=True)
    df = df.filter("transactionId is not null and eventTime is not null and power > 1")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 4  # envelope, call, call of a literal, payload
