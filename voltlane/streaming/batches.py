"""Session lifecycle batch by batch, without a state store and without Python.

Sessions in progress, and for a while closed ones, are rows of a keyed table (``operators.versions``). A micro-batch is
summed up per session in the JVM, before its shuffle, so a session that fills a third of it is a row per task; the few
sums are merged with the table's, and only buckets with changed sessions are written. Message text is never shuffled
by session: it passes from the batch to the live log, less the sessions that were closed before, which are sent to it.

Outputs are written first and the table's entry last. A batch that is repeated because that was not reached finds the
table as it was before; one that is repeated after it is passed over.
"""

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.operators import running, sessions, topics, versions
from voltlane.operators.sessions import GROUP
from voltlane.scratch import staged

# How the sums of two sets of a session's messages merge.
MERGE = {
    "startTime": F.min, "latest": F.max, "endTime": F.max, "eventCount": F.sum, "runningCount": F.sum,
    "powerSum": F.sum, "powerCount": F.sum, "maxPower": F.max, "socStart": F.min, "socEnd": F.max,
    "voltageSum": F.sum, "voltageCount": F.sum, "meterStart": F.max, "meterStop": F.max, "connectorId": F.max,
    "lastOffset": F.max, "idTag": F.max, "terminationReason": F.max,
}
TEXT = ["idTag", "terminationReason"]
KEY = ["sessionId", *GROUP]
STATE = (
    "sessionId STRING, chargerId STRING, transactionId STRING, startTime TIMESTAMP, latest TIMESTAMP, endTime TIMESTAMP, "
    "eventCount BIGINT, runningCount BIGINT, powerSum DOUBLE, powerCount BIGINT, maxPower DOUBLE, socStart DOUBLE, "
    "socEnd DOUBLE, voltageSum DOUBLE, voltageCount BIGINT, meterStart BIGINT, meterStop BIGINT, connectorId INT, "
    "lastOffset BIGINT, idTag STRING, terminationReason STRING, seen TIMESTAMP"
)


def _merged(parts: DataFrame, keys: list[str], names) -> DataFrame:
    return parts.groupBy(*keys).agg(*[MERGE[n](n).alias(n) for n in names])


def session_sums(messages: DataFrame) -> DataFrame:
    """One row per session of a batch of typed messages. The two texts, which only starts and stops have, are keys at
    first, so that numbers are aggregated by hash."""
    on = lambda action, c: F.when(F.col("action") == action, F.col(c))
    one = lambda condition: F.when(condition, 1).otherwise(0).cast("long")
    values = {
        "startTime": "eventTime", "latest": "eventTime", "endTime": F.when(F.col("isStop"), F.col("eventTime")),
        "eventCount": F.lit(1).cast("long"), "runningCount": one(F.col("action") == S.METER),
        "powerSum": "power", "powerCount": one(F.col("power").isNotNull()), "maxPower": "power",
        "socStart": "soc", "socEnd": "soc",
        "voltageSum": "voltage", "voltageCount": one(F.col("voltage").isNotNull()),
        "meterStart": on(S.START, "meterStart"), "meterStop": on(S.STOP, "meterStop"),
        "connectorId": on(S.START, "connectorId"), "lastOffset": "offset",
        "idTag": on(S.START, "idTag"), "terminationReason": on(S.STOP, "reason"),
    }
    rows = messages.select(*KEY, *[(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in values.items()])
    parts = _merged(rows, [*KEY, *TEXT], [n for n in MERGE if n not in TEXT])
    return _merged(parts, KEY, MERGE)


def _closed() -> Column:
    return F.col("endTime").isNotNull()


def run_batch(
    messages: DataFrame,
    sinks: dict,
    path: str,
    batch_id: int,
    closed_ms: int | None,
    idle_ms: int | None,
    buckets: int,
    now: Column | None = None,
) -> None:
    """One batch of typed messages into ``sinks``, and the sessions at ``path`` from before to after it."""
    spark = messages.sparkSession
    done = versions.applied(spark, path)
    if done is not None and batch_id <= done:
        return
    now = spark.range(1).select((F.current_timestamp() if now is None else now).alias("t")).first()["t"]
    before = versions.read_versions(spark, path, empty=STATE)
    new = staged(session_sums(messages), "sums")
    known = staged(before.join(new.select("sessionId"), "sessionId", "left_semi"), "known")
    late = known.filter(_closed()).select("sessionId")
    fresh = new.join(late, "sessionId", "left_anti")
    changed = known.filter(~_closed()).select(*KEY, *MERGE).unionByName(fresh)
    changed = staged(_merged(changed, KEY, MERGE).withColumn("seen", F.lit(now)), "changed")

    def older(ms: int | None) -> Column:
        return F.lit(False) if ms is None else F.col("seen") < F.lit(now - timedelta(milliseconds=ms))

    # Closed or silent for too long.
    out_of_date = F.when(_closed(), older(closed_ms)).otherwise(older(idle_ms))

    # Each batch looks over one bucket more, so sessions that nobody sends messages of go in the end.
    sweep = batch_id % buckets
    swept = before.filter(versions.bucket_of("sessionId", buckets) == sweep)
    gone = swept.join(new.select("sessionId"), "sessionId", "left_anti").filter(out_of_date & ~_closed())
    expired = staged(gone, "expired")

    not_late = messages.join(late, "sessionId", "left_anti")
    state = changed.withColumn("voltageAvg", F.col("voltageSum") / F.nullif("voltageCount", F.lit(0)))
    stopped = state.filter(_closed())
    going = state.filter(~_closed()).withColumn("lastSeen", F.col("latest"))
    live = topics.to_active_state(going.select(*running.state_columns(), F.col("lastOffset").alias("offset")))
    sinks["live"](topics.to_active_raw(not_late).unionByName(live), batch_id)
    sinks["history"](sessions.session_metrics(stopped), batch_id)
    after_stop = messages.join(late, "sessionId", "left_semi")
    topic, key = F.lit(S.ACTIVE_RAW_TOPIC).alias("topic"), F.col("sessionId").alias("key")
    sinks["late"](after_stop.select(topic, key, topics.live_value().alias("value"), "offset"), batch_id)
    sinks["expired"](expired.drop("seen"), batch_id)
    ended = stopped.select("sessionId", "lastOffset").unionByName(expired.select("sessionId", "lastOffset"))
    sinks["tombstones"](topics.to_tombstones(ended.withColumnRenamed("lastOffset", "offset")), batch_id)

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        rest = old.join(new.select("sessionId"), "sessionId", "left_anti")
        return rest.filter(~out_of_date).unionByName(new)

    versions.apply_batch(changed.select(*S.columns(STATE)), path, batch_id, buckets=buckets, merge=merge, also={sweep})
    versions.vacuum(spark, path)
