"""Sessions cut at every stop: the bookkeeping of the older consumer as a grouped aggregation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.functions import calls as C
from voltlane.operators import blocks as B
from voltlane.operators.epochs import with_epoch
from voltlane.operators.sessions import energy


def _tracked(payloads: DataFrame) -> DataFrame:
    """One narrow row per call: what it adds to its session. Readings count only under a timestamp."""
    rows = payloads.withColumn("timed", F.when(F.col("action") == S.METER, C.timed_values(F.col("meterValue"))))
    rows = rows.withColumn("times", F.transform("timed", lambda m: C.event_time(C.utc_text(m["timestamp"]))))
    rows = rows.withColumn("powers", C.power_values(C.samples_of(F.col("timed"))))
    return rows.select(
        "offset",
        "chargerId",
        "action",
        F.coalesce("transactionId", "uniqueId").alias("transactionId"),
        F.array_min("times").alias("firstTime"),
        F.get("times", F.size("times") - 1).alias("lastTime"),
        F.aggregate("powers", F.lit(0.0), lambda a, v: a + v).alias("powerSum"),
        F.when(F.col("powers").isNotNull(), F.size("powers")).cast("long").alias("powerCount"),
        F.when(F.col("action") == S.STOP, C.event_time(C.utc_text(F.col("timestamp")))).alias("stopTime"),
        F.when(F.col("action") == S.STOP, F.col("reason")).alias("reason"),
    )


def track_sessions(
    payloads: DataFrame,
    key: tuple[str, ...] = ("chargerId", "transactionId"),
    include_open: bool = False,
    rows_per_block: int = B.ROWS_PER_BLOCK,
) -> DataFrame:
    """One row per session, closed by each StopTransaction; a later message opens a new one.

    ``key=("transactionId",)`` mixes chargers that reuse an id. ``include_open`` adds the sessions still open at
    the end that have a start time."""
    keys = list(key)
    rows = with_epoch(_tracked(payloads), keys, F.col("action") == S.STOP, "offset", rows_per_block)
    is_stop = F.col("action") == S.STOP
    counted = F.col("action").isin(S.METER, S.STOP, S.STATUS, S.HEARTBEAT)
    last_reading = F.max_by("lastTime", F.when(F.col("lastTime").isNotNull(), F.col("offset")))
    grouped = rows.groupBy(*keys, "epoch").agg(
        F.max(is_stop).alias("closed"),
        F.coalesce(
            F.max_by("chargerId", F.when(is_stop, F.col("offset"))), F.min_by("chargerId", "offset")
        ).alias("stationId"),
        F.min("firstTime").alias("startTime"),
        F.coalesce(F.max("stopTime"), last_reading).alias("endTime"),
        F.sum("powerSum").alias("powerSum"),
        F.sum("powerCount").alias("powerCount"),
        F.count(F.when(counted, 1)).alias("eventCount"),
        F.max("reason").alias("terminationReason"),
    )
    kept = F.col("closed") | F.col("startTime").isNotNull() if include_open else F.col("closed")
    return _session_columns(grouped.filter(kept))


def _session_columns(grouped: DataFrame) -> DataFrame:
    """Duration and energy exist only where there are readings and both times."""
    seconds = (F.unix_micros("endTime") - F.unix_micros("startTime")) / F.lit(1e6)
    known = (F.col("powerCount") > 0) & F.col("startTime").isNotNull() & F.col("endTime").isNotNull()
    return grouped.select(
        F.concat_ws("_", "stationId", F.coalesce(C.iso_text(F.col("startTime")), F.lit("unknown"))).alias("sessionId"),
        "stationId",
        F.when(F.col("closed"), "ended").alias("status"),
        "terminationReason",
        "startTime",
        "endTime",
        F.when(known, seconds.cast("int")).alias("duration"),
        F.when(known, energy(F.col("powerSum") / F.col("powerCount"), seconds, 3)).alias("totalEnergyConsumed"),
        "eventCount",
    )
