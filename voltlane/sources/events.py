"""The ``events`` table as charging traffic: a message topic and a charger log.

Every column is a plain function of one event row, so the same rules can be written in any SQL dialect and the
work grows with the table.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlane import schemas as S

# Stop reasons of the test traffic.
REASONS = ["EVDriverDisconnected", "EmergencyStop", "HardReset", "SoftReset"]


def _each(n: int) -> Column:
    return F.col("event_id") % n == 0


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _stamp(ts: Column) -> Column:
    """ISO text; some rows are written at +05:30 instead of UTC."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    shifted = F.date_format(ts + F.expr("INTERVAL 330 MINUTES"), pattern)
    return F.when(F.col("event_id") % 6 == 1, _text(shifted, "+05:30")).otherwise(
        _text(F.date_format(ts, pattern), "Z")
    )


def _sample(measurand, value, unit: str) -> Column:
    return _text('{"value":"', value, '","context":"Sample.Periodic","format":"Raw","measurand":"', measurand,
                 '","location":"Outlet","unit":"', unit, '"}')


def _meter_value() -> Column:
    """Up to three entries: the reading itself, a second one 30 s later, and one without a timestamp."""
    k = F.get_json_object("props", "$.k").cast("int")
    bad_power = F.when(_each(11), _text(_sample(S.POWER, "n/a", "kW"), ",")).otherwise("")
    soc_name = F.when(_each(2), S.SOC_MEASURANDS[0]).otherwise(S.SOC_MEASURANDS[1])
    voltage = F.when(_each(19), "bad").otherwise((220 + k % 20).cast("string"))
    first = _text(
        '{"timestamp":"', _stamp(F.col("ts")), '","sampledValue":[', bad_power,
        _sample(S.POWER, F.col("value"), "kW"), ",", _sample(soc_name, k, "Percent"), ",",
        _sample(S.VOLTAGE, voltage, "V"), "]}",
    )
    later = _stamp(F.col("ts") + F.expr("INTERVAL 30 SECONDS"))
    second = _text(',{"timestamp":"', later, '","sampledValue":[', _sample(S.POWER, F.col("value") + 1, "kW"), "]}")
    untimed = _text(',{"sampledValue":[', _sample(S.POWER, "9999", "kW"), "]}")
    return _text(
        "[", first, F.when(_each(5), second).otherwise(""), F.when(_each(9), untimed).otherwise(""), "]"
    )


def with_calls(events: DataFrame) -> DataFrame:
    """Adds chargerId, uniqueId, spacedId, action and payload (JSON text) to each event."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    week = F.date_format(F.date_trunc("week", "ts"), "yyyyMMdd")
    number = (F.col("user_id") * 100000000 + week.cast("long")).cast("string")
    # Some chargers send their transaction ids as numbers.
    transaction = F.when(F.col("user_id") % 4 == 0, number).otherwise(_text('"', F.col("user_id"), "_", week, '"'))
    by_type = (
        F.when(F.col("event_type") == "signup", S.START)
        .when(F.col("event_type") == "purchase", S.STOP)
        .when(F.col("event_type") == "error", S.REMOTE_STOP)
        .otherwise(S.METER)
    )
    action = F.when(_each(14), S.STATUS).when(_each(7), S.HEARTBEAT).otherwise(by_type)
    connector = 1 + F.col("user_id") % 2
    reason = F.element_at(F.array(*[F.lit(r) for r in REASONS]), (F.col("event_id") % 4 + 1).cast("int"))
    at = _stamp(F.col("ts"))
    faulted = _each(3)
    payload = (
        F.when(action == S.METER, _text('{"connectorId":', connector, ',"transactionId":', transaction,
                                        ',"meterValue":', _meter_value(), "}"))
        .when(action == S.START, _text('{"connectorId":', connector, ',"idTag":"tag', F.col("user_id"),
                                       '","meterStart":', F.col("event_id"), ',"transactionId":', transaction,
                                       ',"timestamp":"', at, '"}'))
        .when(action == S.STOP, _text('{"meterStop":', F.col("event_id"), ',"transactionId":', transaction,
                                      ',"timestamp":"', at, '","reason":"', reason, '"}'))
        .when(action == S.REMOTE_STOP, _text('{"transactionId":', transaction, ',"timestamp":"', at, '"}'))
        .when(action == S.STATUS, _text('{"connectorId":', connector, ',"errorCode":"',
                                        F.when(faulted, "InternalError").otherwise("NoError"), '","status":"',
                                        F.when(faulted, "Faulted").otherwise("Available"), '","timestamp":"', at,
                                        '","vendorErrorCode":"', F.when(faulted, "012230").otherwise(""), '"}'))
        .otherwise("{}")
    )
    plain_id = _text("m-", F.col("event_id"))
    return e.select(
        "event_id",
        "user_id",
        "ts",
        _text("charger", F.col("user_id") % 10).alias("chargerId"),
        F.when(_each(13), _text("20240101T", F.col("event_id"), "Z")).otherwise(plain_id).alias("uniqueId"),
        F.when(_each(13), _text("20240101 ", F.col("event_id"), "Z")).otherwise(plain_id).alias("spacedId"),
        action.alias("action"),
        payload.alias("payload"),
    )


def event_records(events: DataFrame) -> DataFrame:
    """The message topic: one record per event, offset and arrival in event order."""
    calls = with_calls(events)
    call = _text('[2,"', F.col("uniqueId"), '","', F.col("action"), '",', F.col("payload"), "]")
    return calls.select(
        F.lit(S.MESSAGES_TOPIC).alias("topic"),
        F.col("uniqueId").alias("key"),
        F.to_json(F.struct("chargerId", "uniqueId", call.alias("message"))).alias("value"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def literal_records(events: DataFrame) -> DataFrame:
    """The topic as an old producer left it: calls as Python literals with True and None in them."""
    calls = with_calls(events)
    call = _text("[2, '", F.col("uniqueId"), "', '", F.col("action"), "', {'known': True, 'info': None, 'idTag': \"it's ",
                 F.col("user_id"), "\", 'connectorId': ", 1 + F.col("user_id") % 2, "}]")
    return calls.select(
        F.lit(S.MESSAGES_TOPIC).alias("topic"),
        F.col("uniqueId").alias("key"),
        F.to_json(F.struct("chargerId", "uniqueId", call.alias("message"))).alias("value"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def event_lines(events: DataFrame) -> DataFrame:
    """The charger log, one file per day: requests and responses, repeated and lone calls, comments and junk."""
    calls = with_calls(events)
    head = lambda kind: _text(F.col("chargerId"), f' : [{kind},"', F.col("spacedId"), '"')
    answer = (
        F.when(F.col("action") == S.HEARTBEAT, _text('{"currentTime":"', _stamp(F.col("ts")), '"}'))
        .when(F.col("action") == S.START, _text('{"transactionId":"R', F.col("event_id"), '"}'))
        .otherwise("{}")
    )
    charger = F.col("chargerId")
    junk = (
        F.when(F.col("event_id") % 5 == 0, _text(charger, ' [2,"x', F.col("event_id"), '","Heartbeat",{ }]'))
        .when(F.col("event_id") % 5 == 1, _text(charger, " : [2]"))
        .when(F.col("event_id") % 5 == 2, _text(charger, ' : [2,"x', F.col("event_id"), '","Heartbeat"{ }]'))
        .when(F.col("event_id") % 5 == 3, _text(charger, ' : [9,"x', F.col("event_id"), '","Heartbeat",{}]'))
        .otherwise(_text(charger, ' : {"x":', F.col("event_id"), "}"))
    )
    candidates = [
        F.when(_each(31), _text("# note ", F.col("event_id"))),
        F.when(_each(37), F.lit("")),
        F.when(_each(29), _text(head(2), ',"Heartbeat",{ }]')),
        _text(head(2), ',"', F.col("action"), '",', F.col("payload"), "]"),
        F.when(~_each(10), _text(head(3), ",", answer, "]")),
        F.when(_each(17), _text(charger, ' : [3,"orphan-', F.col("event_id"), '",{}]')),
        F.when(_each(23), junk),
    ]
    lines = calls.select("event_id", "ts", F.posexplode(F.array(*candidates)).alias("pos", "line"))
    return lines.filter(F.col("line").isNotNull()).select(
        F.date_format("ts", "yyyyMMdd").alias("file"), (F.col("event_id") * 8 + F.col("pos")).alias("ord"), "line"
    )


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    """The table, spread over the session's shuffle partitions: each row becomes a long text that is parsed again."""
    return spark.read.parquet(f"{folder.rstrip('/')}/events.parquet").repartition("event_id")
