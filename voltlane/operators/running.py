"""Sessions in progress."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.functions.calls import iso_text, session_id
from voltlane.operators import blocks as B
from voltlane.operators.sessions import GROUP, energy, seconds_between


def state_columns() -> list:
    """Live-state columns from startTime, lastSeen, powerSum, powerCount and runningCount."""
    seconds = seconds_between("startTime", "lastSeen")
    return [
        session_id(F.col("chargerId"), F.col("transactionId")).alias("sessionId"),
        F.col("chargerId").alias("stationId"),
        F.col("transactionId"),
        F.when(F.col("runningCount") > 0, "active").otherwise("pending").alias("status"),
        F.col("startTime"),
        F.col("lastSeen"),
        seconds.alias("duration"),
        F.coalesce(
            F.when(F.col("powerCount") > 0, energy(F.col("powerSum") / F.col("powerCount"), seconds, 4)), F.lit(0.0)
        ).alias("energyConsumedSoFar"),
        F.col("runningCount"),
    ]


def running_state(messages: DataFrame) -> DataFrame:
    """Latest state of every session without a stop."""
    grouped = messages.groupBy(*GROUP).agg(
        F.min("eventTime").alias("startTime"),
        F.max("eventTime").alias("lastSeen"),
        F.sum("power").alias("powerSum"),
        F.count("power").alias("powerCount"),
        F.count(F.when(F.col("action") == S.METER, 1)).alias("runningCount"),
        F.max("isStop").alias("stopped"),
    )
    return grouped.filter(~F.col("stopped")).select(*state_columns())


def running_state_replay(
    messages: DataFrame, order: str = "arrival", rows_per_block: int = B.ROWS_PER_BLOCK, stage: bool = True
) -> DataFrame:
    """State of a session after each of its non-stop messages: in arrival order, as a reader of the live topic
    sees it, or in event-time order."""
    rows = messages.filter(~F.col("isStop")).select(*GROUP, "offset", "eventTime", "power", "action")
    rows = rows.withColumn("reading", (F.col("action") == S.METER).cast("long")).drop("action")
    rows = rows.withColumn("powered", F.col("power").isNotNull().cast("long"))
    if order == "arrival":
        by = ["offset"]
        blocked = B.arrival_blocks(rows, "offset", rows_per_block, stage)
    else:
        by = ["eventTime", "offset"]
        blocked = B.range_blocks(rows, [*GROUP, *by], size=rows_per_block)
    parts = {
        "startTime": ("eventTime", "min"),
        "lastSeen": ("eventTime", "max"),
        "powerSum": ("power", "sum"),
        "powerCount": ("powered", "sum"),
        "runningCount": ("reading", "sum"),
    }
    totals = {f"{name}Before": (B.MERGE[how](F.col(c)), how) for name, (c, how) in parts.items()}
    so_far = B.in_block(GROUP, by).rowsBetween(B.Window.unboundedPreceding, B.Window.currentRow)
    windowed = blocked.rows.withColumns({n: B.MERGE[how](F.col(c)).over(so_far) for n, (c, how) in parts.items()})
    joined = B.with_carry(windowed, blocked, GROUP, totals)
    state = joined.withColumns({n: B.JOIN[how](F.col(f"{n}Before"), F.col(n)) for n, (_, how) in parts.items()})
    return state.select("offset", *state_columns())


def with_first_event_time(
    messages: DataFrame, rows_per_block: int = B.ROWS_PER_BLOCK, stage: bool = True
) -> DataFrame:
    """Each message with the first event time of its session and the id built from it."""
    blocked = B.arrival_blocks(messages, "offset", rows_per_block, stage)
    first = {"sessionStart": (F.min("eventTime"), "min")}
    rows = B.with_carry(blocked.rows, blocked, GROUP, first, whole_group=True).drop("block")
    return rows.withColumn("startSessionId", F.concat_ws("_", "chargerId", iso_text(F.col("sessionStart"))))
