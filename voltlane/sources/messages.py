"""Message topics: Kafka where its connector is installed, or the same rows kept as files."""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.functions import calls as C
from voltlane.functions.literals import literal_to_json

PARTITIONS = S.PARTITIONS


def _arrival(records: DataFrame) -> DataFrame:
    """Offsets made unique across the partitions of a topic; they still rise within each, and a key has one. Records
    without a partition keep their offset."""
    too_many = F.raise_error(F.concat(F.lit("partition out of range: "), F.col("partition").cast("string")))
    packed = F.col("offset") * PARTITIONS + F.when(F.col("partition") < PARTITIONS, F.col("partition")).otherwise(too_many)
    return records.withColumn("offset", F.when(F.col("partition").isNull(), F.col("offset")).otherwise(packed)).drop(
        "partition"
    )


def read_messages_stream(
    spark: SparkSession, path: str | None = None, format: str = "kafka", **options
) -> DataFrame:
    """Stream of topic, key, value, offset, timestamp, from the earliest record on. Files may name the partition of a
    record, as Kafka does."""
    if format == "kafka":
        defaults = {"subscribe": S.MESSAGES_TOPIC, "startingOffsets": "earliest", "failOnDataLoss": "false"}
        return _arrival(spark.readStream.format("kafka").options(**{**defaults, **options}).load())
    return _arrival(spark.readStream.format(format).schema(S.PARTITIONED_LOG).options(**options).load(path))


def read_messages_batch(
    spark: SparkSession, path: str | None = None, format: str = "kafka", **options
) -> DataFrame:
    """All records of the topic at once, earliest to latest."""
    if format == "kafka":
        defaults = {"subscribe": S.MESSAGES_TOPIC, "startingOffsets": "earliest", "endingOffsets": "latest"}
        return _arrival(spark.read.format("kafka").options(**{**defaults, **options}).load())
    return _arrival(spark.read.format(format).schema(S.PARTITIONED_LOG).options(**options).load(path))


def decode_envelope(records: DataFrame) -> DataFrame:
    """Records to topic, offset, uniqueId, chargerId, message. A bad envelope leaves null fields; the record key
    stands in for a missing uniqueId."""
    data = C.evaluate_once(records, data=F.from_json(F.col("value").cast("string"), S.ENVELOPE))
    return data.select(
        "topic",
        "offset",
        F.coalesce("data.uniqueId", F.col("key").cast("string")).alias("uniqueId"),
        "data.chargerId",
        "data.message",
        F.col("data.transactionId").alias("suppliedTransactionId"),
    )


def decode_calls(
    records: DataFrame, python_literals: bool = True, session_only: bool = False, actions: list[str] | None = None
) -> DataFrame:
    """Records to one row per decodable call: header columns and the payload as text, not parsed.

    Calls of fewer than three elements are dropped. Calls stored as Python literals, with True, False or None in them,
    are read too; ``python_literals=False`` drops them. ``session_only`` keeps the four session actions, ``actions`` those
    named, before payloads are parsed."""
    calls = decode_envelope(records)
    actions = S.SESSION_ACTIONS if session_only else actions
    if actions is not None:
        # Cheap test before any JSON parse. An action may also be spelt with escapes or, in a Python literal, in
        # adjacent pieces; such texts stay in and are parsed.
        text = F.col("message")
        spelt = text.rlike(r"""[\\#]|["']\s*["']""")
        named = [text.contains(part) for part in (["MeterValues", "Transaction"] if session_only else actions)]
        calls = calls.filter(reduce(or_, named) | spelt)
    calls = C.evaluate_once(calls, call=C.call_elements(F.col("message")))
    if python_literals:
        text = literal_to_json(F.when(F.col("call").isNull(), F.col("message")))
        calls = calls.withColumn("literal", text)
        read = F.coalesce("call", C.call_elements(F.col("literal")))
        calls = C.evaluate_once(calls, read=read).drop("call", "literal").withColumnRenamed("read", "call")
    calls = calls.filter(F.size("call") >= 3).withColumn("action", F.get("call", F.lit(2)))
    if actions is not None:
        calls = calls.filter(F.col("action").isin(actions))
    body = F.coalesce(F.get("call", F.lit(3)), F.lit("{}"))
    return calls.withColumn("payload", body).drop("call")


def decode_payloads(
    records: DataFrame, python_literals: bool = True, session_only: bool = False, contract: str = S.PAYLOAD
) -> DataFrame:
    """The rows of ``decode_calls`` with the payload's fields as text and meterValue as an array."""
    calls = decode_calls(records, python_literals, session_only)
    decoded = calls.select("*", F.inline(F.array(C.payload_struct(F.col("payload"), contract))))
    decoded = decoded.withColumns({c: C.number_text(F.col(c)) for c in S.NUMBERS})
    return decoded.withColumn("transactionId", F.coalesce("transactionId", "suppliedTransactionId")).drop(
        "suppliedTransactionId"
    )


def decode_messages(
    records: DataFrame,
    soc_measurands: list[str] = S.SOC_MEASURANDS,
    strict_millis: bool = False,
    python_literals: bool = True,
    normalize_units: bool = False,
    session_only: bool = False,
) -> DataFrame:
    """Records to typed messages, one row per call, with no call dropped for missing fields."""
    calls = decode_payloads(records, python_literals, session_only)
    calls = calls.withColumn("samples", C.samples_of(F.col("meterValue")))
    stamp = C.timestamp_text(F.col("action"), F.col("timestamp"), F.col("meterValue"))
    event = C.event_time(F.col("timestamp_str"), strict_millis)
    return (
        C.evaluate_once(C.evaluate_once(calls, timestamp_str=stamp), eventTime=event)
        .select(
            "topic",
            "offset",
            "uniqueId",
            "chargerId",
            "message",
            "action",
            "transactionId",
            "timestamp_str",
            F.get(C.power_values(F.col("samples"), normalize_units), F.lit(0)).alias("power"),
            C.whole_number(F.col("meterStart"), "bigint").alias("meterStart"),
            C.whole_number(F.col("meterStop"), "bigint").alias("meterStop"),
            "idTag",
            C.whole_number(F.col("connectorId"), "int").alias("connectorId"),
            C.first_sample(F.col("samples"), soc_measurands).alias("soc"),
            C.first_sample(F.col("samples"), [S.VOLTAGE]).alias("voltage"),
            "reason",
            "eventTime",
            C.session_id(F.col("chargerId"), F.col("transactionId")).alias("sessionId"),
            F.col("action").isin(S.STOP_ACTIONS).alias("isStop"),
        )
    )


def decode_status(records: DataFrame) -> DataFrame:
    """StatusNotification calls as columns. Of the other calls only the header is parsed, of these the fields used."""
    calls = decode_calls(records, actions=[S.STATUS])
    calls = calls.select("chargerId", "offset", F.inline(F.array(C.payload_struct(F.col("payload"), S.STATUS_PAYLOAD))))
    stamp = C.event_time(C.utc_text(F.col("timestamp")))
    return calls.select(
        "chargerId",
        C.whole_number(C.number_text(F.col("connectorId")), "int").alias("connectorId"),
        "status",
        "errorCode",
        "vendorErrorCode",
        stamp.alias("eventTime"),
        "offset",
    )


def decode_samples(records: DataFrame) -> DataFrame:
    """One row per sampled value of every MeterValues call whose entry carries a timestamp."""
    calls = decode_payloads(records, session_only=True, contract=S.FULL_PAYLOAD)
    calls = calls.filter(F.col("action") == S.METER)
    entries = calls.select(
        "offset", "uniqueId", "chargerId", "transactionId", F.posexplode(C.timed_values(F.col("meterValue")))
    )
    entries = entries.select(
        "offset",
        "uniqueId",
        "chargerId",
        "transactionId",
        F.col("pos").alias("entry"),
        C.event_time(C.utc_text(F.col("col.timestamp"))).alias("sampleTime"),
        F.posexplode("col.sampledValue").alias("position", "sample"),
    )
    return entries.select(
        "offset",
        "uniqueId",
        "chargerId",
        "transactionId",
        "entry",
        "position",
        "sampleTime",
        "sample.measurand",
        "sample.unit",
        "sample.context",
        "sample.format",
        "sample.location",
        C.number_of(F.col("sample")).alias("value"),
    )


def pivot_samples(samples: DataFrame, measurands: list[str] = S.MEASURANDS) -> DataFrame:
    """One row per message with the first value of each measurand."""
    place = F.struct("entry", "position")
    firsts = [
        F.min_by(F.when(F.col("measurand") == m, F.col("value")), F.when(F.col("measurand") == m, place)).alias(m)
        for m in measurands
    ]
    return samples.groupBy("offset", "uniqueId", "chargerId", "transactionId").agg(*firsts)
