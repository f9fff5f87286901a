"""Predicates of the session path."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlane import schemas as S


def has_transaction(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("transactionId").isNotNull())


def valid_actions(messages: DataFrame, actions: list[str] = S.SESSION_ACTIONS) -> DataFrame:
    return messages.filter(F.col("action").isin(actions))


def has_timestamp(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("timestamp_str").isNotNull() & F.col("eventTime").isNotNull())


def session_messages(messages: DataFrame) -> DataFrame:
    """The messages sessions are built from."""
    return has_timestamp(valid_actions(has_transaction(messages)))


def active_messages(messages: DataFrame) -> DataFrame:
    return messages.filter(~F.col("isStop"))


def stop_messages(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("isStop"))


def since(column: str, as_of: Column, days: int) -> Column:
    return F.col(column) >= as_of - F.make_dt_interval(F.lit(days))


def retained(df: DataFrame, column: str, as_of: Column, days: int) -> DataFrame:
    """Rows no older than ``days`` before ``as_of``."""
    return df.filter(since(column, as_of, days))


def key_starts_with(records: DataFrame, prefix: str) -> DataFrame:
    return records.filter(F.col("key").startswith(prefix))
