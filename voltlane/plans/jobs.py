"""Whole batch jobs: log files to topics, topics to tables."""

from pyspark.sql import DataFrame, SparkSession

from voltlane import schemas as S
from voltlane.operators import filters, lines, pairing, sessions, tables, topics, tracker, versions
from voltlane.scratch import staged
from voltlane.sources import logs, messages


def ingest_logs(
    spark: SparkSession,
    paths,
    message_sink,
    dead_letter_sink,
    pair_scope: str = "file",
    python_literals: bool = True,
    recover_transaction_id: bool = False,
) -> DataFrame:
    """Log files to the message topic and the dead-letter topic; returns the counts per outcome.

    A sink is a function that writes a DataFrame of topic, key and value. Lines are parsed and matched once; the
    outcome table is kept for the two sinks and the counts."""
    parsed = lines.parse_lines(logs.read_log(spark, paths), python_literals)
    result = staged(pairing.outcomes(parsed, pair_scope), "outcomes")
    message_sink(topics.to_message_log(result, recover_transaction_id))
    dead_letter_sink(topics.to_dead_letter(result))
    return pairing.ingest_counts(result)


def typed_sessions(records: DataFrame, **options) -> DataFrame:
    """Message records to the typed messages that sessions are built from."""
    return filters.session_messages(messages.decode_messages(records, session_only=True, **options))


def completed_from_log(records: DataFrame, **options) -> DataFrame:
    return sessions.completed_sessions(typed_sessions(records), **options)


def tracked_from_log(records: DataFrame, **options) -> DataFrame:
    return tracker.track_sessions(messages.decode_payloads(records), **options)


def keep_charger_sessions(records: DataFrame, path: str, batch_id: int, **options) -> bool:
    """The older consumer's sessions into their keyed table, once per batch. A session that the table has, or that the batch
    has twice, is not replaced: its first row counts, and of several in a batch the highest."""
    rows = tables.aligned(tracked_from_log(records, **options), S.CHARGER_SESSION)
    return versions.apply_batch(rows, path, batch_id, on_conflict="skip")


def keep_compacted(records: DataFrame, path: str) -> bool:
    """Bring what a log has gained since the last call into its compacted table. Marks are set last: after a failure before
    that, records are brought in once more, which changes nothing, as the one of the highest offset counts."""
    last = versions.applied(records.sparkSession, path)
    number = 0 if last is None else last + 1
    new = staged(topics.newer_records(records, path), "new")
    done = topics.compact_batch(new, path, number)
    return topics.mark_batch(new, path, number) and done
