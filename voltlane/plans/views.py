"""Analytic views over sessions and messages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlane.functions.calls import event_time
from voltlane.operators import filters, topics
from voltlane.operators.tables import keys_in_both


def recent(history: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Sessions started in the last ``days``. Where the table is partitioned by day, older days are not read."""
    if "day" in history.columns:
        history = history.filter(F.col("day") >= F.to_date(as_of - F.make_dt_interval(F.lit(days))))
    return history.filter(filters.since("startTime", as_of, days))


def energy_by_station(history: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return recent(history, as_of, days).groupBy("stationId").agg(
        F.count("*").alias("sessions"), F.sum("totalEnergyConsumed").alias("totalEnergy")
    )


def termination_stats(history: DataFrame) -> DataFrame:
    return history.groupBy("terminationReason").agg(
        F.count("*").alias("sessions"), F.avg("totalEnergyConsumed").alias("avgEnergy")
    )


def station_sessions(history: DataFrame, station: str, as_of: Column, days: int = 7) -> DataFrame:
    return recent(history, as_of, days).filter(F.col("stationId") == station)


def active_overview(records: DataFrame) -> DataFrame:
    """All sessions that are live according to the active topic."""
    return topics.active_state_from(records)


def session_messages(
    raw_records: DataFrame, prefix: str, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Live log of a charger or session, by the start of its key and, if given, a time range."""
    found = filters.key_starts_with(raw_records.filter(F.col("value").isNotNull()), prefix)
    at = event_time(F.get_json_object("value", "$.timestamp"))
    if start is not None:
        found = found.filter(at >= start)
    return found if end is None else found.filter(at < end)


def sessions_by(history: DataFrame, grain: str = "day", dims: tuple[str, ...] = ("stationId",)) -> DataFrame:
    return history.groupBy(F.date_trunc(grain, "startTime").alias("period"), *dims).agg(*_session_totals())


def sessions_by_each(history: DataFrame, grains: tuple[str, ...] = ("day", "week"), dims: tuple[str, ...] = ("stationId",)) -> DataFrame:
    """Totals at several grains, each by ``dims`` and over all of them, and over all time, in one pass by grouping sets.

    ``grain`` names the grain of a row (null: all time), ``period`` its start; a dimension that a row sums over is null, and
    ``level`` says how many of the dimensions it keeps."""
    rows = history.withColumns({f"__{g}": F.date_trunc(g, "startTime") for g in grains})
    columns = [f"__{g}" for g in grains]
    sets = [[*period, *kept] for period in ([c] for c in columns) for kept in (list(dims), [])] + [list(dims), []]
    grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in [*columns, *dims]])
    flags = [F.grouping(c).alias(f"__no_{c}") for c in [*columns, *dims]]
    found = grouped.agg(*flags, *_session_totals())
    held = lambda c: F.col(f"__no_{c}") == 0
    return found.select(
        F.coalesce(*[F.when(held(f"__{g}"), F.lit(g)) for g in grains], F.lit(None)).alias("grain"),
        F.coalesce(*columns, F.lit(None)).alias("period"),
        *dims,
        sum((held(d).cast("int") for d in dims), F.lit(0)).alias("level"),
        *[c for c in found.columns if c not in [*columns, *dims] and not c.startswith("__no_")],
    )


def _session_totals():
    return [
        F.count("*").alias("sessions"),
        F.sum("totalEnergyConsumed").alias("totalEnergy"),
        F.sum(F.col("duration").cast("long")).alias("totalDuration"),
        F.avg("avgPower").alias("avgPower"),
        F.max("maxPower").alias("maxPower"),
    ]


def station_health(status_rows: DataFrame) -> DataFrame:
    """Latest status of each connector and the number of its error reports."""
    place = F.struct("eventTime", "offset")
    latest = status_rows.groupBy("chargerId", "connectorId").agg(
        F.max_by(F.struct("status", "errorCode", "vendorErrorCode"), place).alias("latest"),
        F.max("eventTime").alias("lastReport"),
        F.count("*").alias("reports"),
        F.count(F.when(F.col("errorCode") != "NoError", 1)).alias("errors"),
    )
    return latest.select("chargerId", "connectorId", "latest.*", "lastReport", "reports", "errors")


def last_heartbeat(parsed: DataFrame) -> DataFrame:
    """Latest heartbeat time per charger, as its response reports it."""
    stamp = F.get_json_object("message", "$[2].currentTime").try_cast("timestamp")
    beats = parsed.filter(F.col("kind") == "response").select("chargerId", stamp.alias("at"))
    return beats.filter(F.col("at").isNotNull()).groupBy("chargerId").agg(F.max("at").alias("lastHeartbeat"))


def all_chargers(messages: DataFrame) -> DataFrame:
    return messages.select("chargerId").distinct()


def all_actions(messages: DataFrame) -> DataFrame:
    return messages.select("action").distinct()


def charger_payloads(payloads: DataFrame, charger: str) -> DataFrame:
    """Request payloads of one charger as JSON text."""
    return payloads.filter(F.col("chargerId") == charger).select("uniqueId", "action", "payload")


def lookup(sessions: DataFrame, **equals) -> DataFrame:
    """Rows whose columns equal the given values, such as sessionId or stationId."""
    for column, value in equals.items():
        sessions = sessions.filter(F.col(column) == value)
    return sessions


def newest_sessions(history: DataFrame, n: int = 10) -> DataFrame:
    return history.orderBy(F.desc("startTime"), "sessionId").limit(n)


def distinct_sessions(messages: DataFrame) -> DataFrame:
    return messages.select("sessionId").distinct()


def bridge(active: DataFrame, history: DataFrame) -> DataFrame:
    """Live and completed sessions as one table; a completed row wins over a live one of the same session."""
    live = active.select(
        "sessionId",
        "stationId",
        "transactionId",
        "status",
        F.col("startTime").cast("timestamp").alias("startTime"),
        F.col("lastSeen").cast("timestamp").alias("lastSeen"),
        "duration",
        F.col("energyConsumedSoFar").alias("totalEnergyConsumed"),
        F.col("runningCount").alias("eventCount"),
    )
    live = live.join(keys_in_both(history, live), "sessionId", "left_anti")
    return history.select(*live.columns).unionByName(live)


def register_views(history: DataFrame, active: DataFrame) -> None:
    """Temp views for ad-hoc spark.sql."""
    history.createOrReplaceTempView("history")
    active.createOrReplaceTempView("active")
    bridge(active, history).createOrReplaceTempView("sessions")
