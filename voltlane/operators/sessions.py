"""Sessions: all messages of one charger and transaction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.functions.calls import session_id
from voltlane.operators import blocks as B
from voltlane.operators.epochs import with_epoch

# What makes a session; its id follows from these.
GROUP = ["chargerId", "transactionId"]


def seconds_between(start, end):
    return (F.unix_timestamp(end) - F.unix_timestamp(start)).cast("int")


def stable_round(value, digits):
    """Rounded half up. The first step takes off what the order of a float sum leaves behind, so that two runs
    do not round a tie differently."""
    return F.round(F.round(value, 9), digits)


def energy(avg_power, seconds, digits):
    return stable_round(avg_power * (seconds / F.lit(3600)), digits)


def _aggregates(stop_actions: list[str] = S.STOP_ACTIONS, soc_by_time: bool = False) -> dict:
    on_start = lambda c: F.max(F.when(F.col("action") == S.START, F.col(c)))
    on_stop = lambda c: F.max(F.when(F.col("action") == S.STOP, F.col(c)))
    if soc_by_time:
        at = F.when(F.col("soc").isNotNull(), F.col("eventTime"))
        soc_start, soc_end = F.min_by("soc", at), F.max_by("soc", at)
    else:
        soc_start, soc_end = F.min("soc"), F.max("soc")
    return {
        "startTime": F.min("eventTime"),
        "endTime": F.max(F.when(F.col("action").isin(stop_actions), F.col("eventTime"))),
        "eventCount": F.count("*"),
        "terminationReason": on_stop("reason"),
        "powerSum": F.sum("power"),
        "powerCount": F.count("power"),
        "meterStart": on_start("meterStart"),
        "meterStop": on_stop("meterStop"),
        "idTag": on_start("idTag"),
        "connectorId": on_start("connectorId"),
        "socStart": soc_start,
        "socEnd": soc_end,
        "socAvg": F.avg("soc"),
        "maxPower": F.max("power"),
        "voltageAvg": F.avg("voltage"),
        "voltageMin": F.min("voltage"),
        "voltageMax": F.max("voltage"),
    }


def session_aggregates(**options) -> list:
    return [c.alias(n) for n, c in _aggregates(**options).items()]


def _aggregated_by_hash(messages: DataFrame, keys: list[str], stop_actions: list[str] = S.STOP_ACTIONS) -> DataFrame:
    """``session_aggregates`` without a sort of all rows.

    Spark sorts where it aggregates text. So the two texts, which only start and stop messages have, are keys at first:
    all numbers are aggregated by hash, which leaves a few rows per session, and only those are merged with the texts."""
    every = _aggregates(stop_actions)
    text = {
        "terminationReason": F.when(F.col("action") == S.STOP, F.col("reason")),
        "idTag": F.when(F.col("action") == S.START, F.col("idTag")),
    }
    averages = {"socAvg": "soc", "voltageAvg": "voltage"}
    numbers = {n: c for n, c in every.items() if n not in text and n not in averages}
    sums = {f"{c}{how.__name__}": how(c) for c in averages.values() for how in (F.sum, F.count)}
    parts = messages.withColumns({f"{n}Text": c for n, c in text.items()}).groupBy(*keys, *[f"{n}Text" for n in text])
    parts = parts.agg(*[c.alias(n) for n, c in (numbers | sums).items()])
    least, added = ("startTime", "socStart", "voltageMin"), ("eventCount", "powerSum", "powerCount")
    merged = {n: (F.min if n in least else F.sum if n in added else F.max)(n) for n in numbers}
    merged |= {n: F.max(f"{n}Text") for n in text}
    merged |= {n: F.sum(f"{c}sum") / F.nullif(F.sum(f"{c}count"), F.lit(0)) for n, c in averages.items()}
    return parts.groupBy(*keys).agg(*[merged[n].alias(n) for n in every])


def session_aggregate(messages: DataFrame, epoch: bool = False, **options) -> DataFrame:
    """One row per session. ``epoch`` starts a new session after each stop of a reused transactionId."""
    keys = GROUP
    if epoch:
        used = ["action", "eventTime", "power", "soc", "voltage", "meterStart", "meterStop", "idTag", "connectorId"]
        messages = messages.select(*GROUP, "offset", "isStop", "reason", *used)
        messages, keys = with_epoch(messages, GROUP, F.col("isStop")), [*GROUP, "epoch"]
    if options.pop("soc_by_time", False):
        grouped = messages.groupBy(*keys).agg(*session_aggregates(soc_by_time=True, **options))
    else:
        grouped = _aggregated_by_hash(messages, keys, **options)
    return grouped.withColumn("sessionId", F.concat_ws("_", *keys)).drop("epoch")


def session_metrics(aggregated: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Completed sessions in the history layout, derived from their aggregates."""
    done = aggregated.filter(F.col("endTime").isNotNull())
    done = done.withColumn("stationId", F.col("chargerId")).withColumn("lastSeen", F.col("endTime"))
    done = done.withColumn("status", F.lit("completed"))
    done = done.withColumn("duration", seconds_between("startTime", "endTime"))
    done = done.withColumn("avgPower", F.when(F.col("powerCount") > 0, F.col("powerSum") / F.col("powerCount")))
    done = done.withColumn("totalEnergyConsumed", energy(F.col("avgPower"), F.col("duration"), 3))
    return done.select(*S.columns(S.HISTORY), *extra)


def completed_sessions(messages: DataFrame, **options) -> DataFrame:
    return session_metrics(session_aggregate(messages, **options))


def session_status(messages: DataFrame) -> DataFrame:
    """Every session classified: no status without readings, active with readings, ended once a stop is there."""
    is_meter, is_stop = F.col("action") == S.METER, F.col("isStop")
    # The reason is a key at first, see _aggregated_by_hash.
    reason = F.when(F.col("action") == S.STOP, F.col("reason"))
    parts = messages.withColumn("stopReason", reason).groupBy(*GROUP, "stopReason").agg(
        F.count(F.when(is_meter, 1)).alias("readings"),
        F.min(F.when(is_meter, F.col("eventTime"))).alias("firstReading"),
        F.min("eventTime").alias("first"),
        F.max(F.when(is_stop, F.col("eventTime"))).alias("endTime"),
        F.max("eventTime").alias("latest"),
        F.sum("power").alias("powerSum"),
        F.count("power").alias("powerCount"),
        F.count("*").alias("eventCount"),
    )
    grouped = parts.groupBy(*GROUP).agg(
        F.sum("readings").alias("readings"),
        F.coalesce(F.min("firstReading"), F.min("first")).alias("startTime"),
        F.max("endTime").alias("endTime"),
        F.max("latest").alias("latest"),
        F.max("stopReason").alias("reason"),
        (F.sum("powerSum") / F.nullif(F.sum("powerCount"), F.lit(0))).alias("avgPower"),
        F.sum("eventCount").alias("eventCount"),
    )
    status = F.when(F.col("readings") > 0, F.when(F.col("endTime").isNotNull(), "ended").otherwise("active"))
    grouped = grouped.withColumn("status", status).withColumn("lastSeen", F.coalesce("endTime", "latest"))
    grouped = grouped.withColumn("duration", seconds_between("startTime", "lastSeen"))
    return grouped.select(
        session_id(F.col("chargerId"), F.col("transactionId")).alias("sessionId"),
        F.col("chargerId").alias("stationId"),
        "status",
        F.when(F.col("status") == "ended", F.col("reason")).alias("terminationReason"),
        "startTime",
        "endTime",
        "lastSeen",
        "duration",
        energy(F.col("avgPower"), F.col("duration"), 3).alias("totalEnergyConsumed"),
        "eventCount",
    )


def trapezoid_energy(messages: DataFrame, blocks: int | None = None) -> DataFrame:
    """Energy per session as the integral of power over time, between neighbouring readings."""
    key = ["sessionId"]
    order = ["sessionId", "eventTime", "offset"]
    readings = messages.filter(F.col("power").isNotNull()).select(*order, "power")
    blocked = B.range_blocks(readings, order, blocks)
    reading = F.struct("eventTime", "power")
    last = {"earlier": (F.max_by(reading, F.struct("eventTime", "offset")), "last")}
    rows = blocked.rows.withColumn("before", F.lag(reading).over(B.in_block(key, ["eventTime", "offset"])))
    rows = B.with_carry(rows, blocked, key, last).withColumn("before", F.coalesce("before", "earlier"))
    micros = F.unix_micros("eventTime") - F.unix_micros("before.eventTime")
    slice_kwh = (F.col("power") + F.col("before.power")) / 2 * micros / F.lit(3.6e9)
    return rows.groupBy(*key).agg(
        stable_round(F.coalesce(F.sum(slice_kwh), F.lit(0.0)), 3).alias("energy"), F.count("*").alias("readings")
    )
