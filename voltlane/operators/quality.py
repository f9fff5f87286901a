"""Checks over the history and active tables. Each returns the rows that break its rule, or counts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlane.operators.tables import keys_in_both

# Columns that may not be null.
REQUIRED = ["sessionId", "stationId", "transactionId", "startTime", "endTime", "duration"]


def required_nulls(history: DataFrame) -> DataFrame:
    """Number of nulls per required column, as one row."""
    return history.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in REQUIRED])


def meter_order(history: DataFrame) -> DataFrame:
    return history.filter(F.col("meterStop") < F.col("meterStart"))


def energy_mismatch(history: DataFrame, tolerance: float = 0.01) -> DataFrame:
    expected = F.col("avgPower") * F.col("duration") / 3600
    return history.filter(F.abs(F.col("totalEnergyConsumed") - expected) > tolerance)


def duration_mismatch(history: DataFrame, tolerance: int = 1) -> DataFrame:
    expected = F.unix_timestamp("endTime") - F.unix_timestamp("startTime")
    return history.filter(F.abs(F.col("duration") - expected) > tolerance)


def active_and_completed(active: DataFrame, history: DataFrame) -> DataFrame:
    """Sessions found in both; there should be none."""
    return keys_in_both(history, active)


def not_completed(history: DataFrame) -> DataFrame:
    return history.filter(~F.coalesce(F.col("status") == "completed", F.lit(False)))
