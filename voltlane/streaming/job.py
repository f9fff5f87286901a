"""The live job: message stream to live log, live state, history and tombstones."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.functions.calls import session_id
from voltlane.operators import running, sessions, tables, topics, versions
from voltlane.operators.sessions import GROUP
from voltlane.streaming import batches, lifecycle

# How long a continuous run remembers closed sessions, and sessions that fall silent.
CLOSED_MS, IDLE_MS = 24 * 3600 * 1000, 7 * 24 * 3600 * 1000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark) -> None:
    """State outgrows the heap, so it is kept in RocksDB with changelog checkpoints; that of a join in one store for each
    task instead of four, for new checkpoints (an old one keeps its format)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.streaming.join.stateFormatVersion", "3")


def session_stream(messages: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Aggregates per session over a stream, for update mode. The keys hold no time column, so the watermark
    neither drops late rows nor evicts state; start_lifecycle bounds its state instead."""
    aggregates = sessions.session_aggregates() + [
        F.max("eventTime").alias("latest"),
        F.max("isStop").alias("stopped"),
        F.max("offset").alias("lastOffset"),
        F.count(F.when(F.col("action") == S.METER, 1)).alias("runningCount"),
    ]
    grouped = messages.withWatermark("eventTime", watermark).groupBy(*GROUP).agg(*aggregates)
    return grouped.withColumn("sessionId", session_id(F.col("chargerId"), F.col("transactionId")))


def live_state(aggregated: DataFrame) -> DataFrame:
    """Live topic records of the sessions without a stop."""
    going = aggregated.filter(~F.col("stopped")).withColumn("lastSeen", F.col("latest"))
    return topics.to_active_state(going.select(*running.state_columns(), F.col("lastOffset").alias("offset")))


def tombstones(stopped: DataFrame) -> DataFrame:
    """Tombstones of stopped sessions, placed after their last message."""
    return topics.to_tombstones(stopped.select("sessionId", F.col("lastOffset").alias("offset")))


def file_sinks(out: str) -> dict:
    """Live topics, late messages and history as Parquet folders under ``out``, one sub-folder per batch."""
    write = lambda name: lambda df, batch_id: tables.write_batch(df, f"{out}/{name}", batch_id)
    live = {"live": write("live/kind=records"), "tombstones": write("live/kind=tombstones")}
    return live | {name: write(name) for name in ("history", "late", "expired")}


def kafka_sink(**options):
    """Sink for ``live`` and ``tombstones``: each record goes to the topic it names. A repeated batch repeats records,
    which compaction folds away."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.select("topic", "key", "value").write.format("kafka").options(**options).save()

    return write


def merge_sink(merge, key: str = "sessionId", order: str | Column | None = None, format: str = "jdbc", **staging):
    """Sink for ``history`` in a keyed table that replaces the sessions it knows and adds the others.

    The batch, with one row per key, overwrites a staging table (any Spark sink, its place in ``staging``); then
    ``merge(spark, batch_id)`` brings it into the target, for instance by running ``tables.merge_statement`` in the
    database. Spark reads neither table back, and a repeated batch changes nothing."""

    def write(df: DataFrame, batch_id: int) -> None:
        rest = [c for c in df.columns if c != key]
        newest = tables.last_per_key(df, [key], F.struct(*rest) if order is None else order)
        newest.write.format(format).options(**staging).mode("overwrite").save()
        merge(df.sparkSession, batch_id)

    return write


def merge_once_sink(
    transact,
    target: str,
    staging: str,
    ledger: str,
    job: str = "history",
    key: str = "sessionId",
    order: str | Column | None = None,
    format: str = "jdbc",
    **options,
):
    """Sink for ``history`` in a keyed table of a database, exactly once.

    As in ``merge_sink`` the batch overwrites a staging table (any Spark sink, its place in ``options``), here with its
    number. ``transact(spark, statements)`` runs the statements of ``tables.merge_once_statements`` in one transaction, so
    that the rows and the entry in the ledger become visible together. A batch that is repeated after a failure before
    that is applied, after that it is not, even if the target has been changed since."""

    def write(df: DataFrame, batch_id: int) -> None:
        rest = [c for c in df.columns if c != key]
        newest = tables.last_per_key(df, [key], F.struct(*rest) if order is None else order)
        newest.withColumn("batch_id", F.lit(batch_id).cast("long")).write.format(format).options(**options).mode("overwrite").save()
        transact(df.sparkSession, tables.merge_once_statements(target, staging, ledger, df.columns, batch_id, job, key))

    return write


def versioned_sink(path: str, key: str = "sessionId", order: str | Column | None = None, buckets: int = versions.BUCKETS):
    """Sink for ``history`` in a keyed table of Parquet files, exactly once and without a database."""

    def write(df: DataFrame, batch_id: int) -> None:
        versions.apply_batch(df, path, batch_id, key, order, buckets=buckets)

    return write


def catalog_sink(table: str, key: str = "sessionId", order: str | Column | None = None):
    """Sink for ``history`` in a catalog table whose format takes row-level changes: a merge by key in one step."""

    def write(df: DataFrame, batch_id: int) -> None:
        rest = [c for c in df.columns if c != key]
        newest = tables.last_per_key(df, [key], F.struct(*rest) if order is None else order).alias("s")
        same = F.expr(f"{table}.{key} = s.{key}")
        newest.mergeInto(table, same).whenMatched().updateAll().whenNotMatched().insertAll().merge()

    return write


def start_live_log(messages: DataFrame, sinks: dict, checkpoint: str, **trigger):
    """The live log alone, without state. A message after the stop of its session is written too; readers take
    topics.after_last_tombstone or leave out stopped sessions."""
    log = topics.to_active_raw(messages)
    writer = log.writeStream.outputMode("append").foreachBatch(sinks["live"])
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_sessions(messages: DataFrame, sinks: dict, checkpoint: str, **trigger):
    """Live state, history and tombstones from one aggregated stream.

    Each batch holds the sessions it changed. Spark combines the rows of a session before the shuffle, so a
    crowded session stays cheap, and a message after the stop updates history without reviving the session."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            stopped = batch.filter(F.col("stopped"))
            sinks["live"](live_state(batch), batch_id)
            sinks["history"](sessions.session_metrics(batch), batch_id)
            # Last, and only once the rest is written.
            sinks["tombstones"](tombstones(stopped), batch_id)
        finally:
            batch.unpersist()

    writer = session_stream(messages).writeStream.outputMode("update").foreachBatch(sink)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_lifecycle(
    messages: DataFrame,
    sinks: dict,
    checkpoint: str,
    closed_ms: int | None = None,
    idle_ms: int | None = None,
    **trigger,
):
    """Live log, live state, history and tombstones from one stream whose state is dropped after the stop.

    One query writes all of them, and a batch's tombstones in a write of their own after all the rest, so no live
    record can follow the tombstone of its session. Messages after the stop go to ``late``, sessions that never stop
    to ``expired``. A run that goes on bounds its state: ``closed_ms`` is a day and ``idle_ms`` a week unless given."""
    if not trigger.get("availableNow") and not trigger.get("once"):
        closed_ms, idle_ms = closed_ms or CLOSED_MS, idle_ms or IDLE_MS

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            record = [F.lit(S.ACTIVE_RAW_TOPIC).alias("topic"), F.col("sessionId").alias("key"), "value", "offset"]
            session = F.from_json("value", lifecycle.SESSION).alias("session")
            state = batch.filter("kind in ('state', 'closed', 'expired')")
            state = state.select("kind", "chargerId", "transactionId", "sessionId", session).select("*", "session.*")
            raw = batch.filter("kind = 'raw'").select(*record)
            changes = live_state(state.withColumn("stopped", F.col("kind") != "state"))
            gone = tombstones(state.filter("kind <> 'state'"))
            sinks["live"](raw.unionByName(changes), batch_id)
            sinks["history"](sessions.session_metrics(state.filter("kind = 'closed'")), batch_id)
            sinks["late"](batch.filter("kind = 'late'").select(*record), batch_id)
            expired = state.filter("kind = 'expired'").select("sessionId", "chargerId", "transactionId", "session.*")
            sinks["expired"](expired, batch_id)
            sinks["tombstones"](gone, batch_id)
        finally:
            batch.unpersist()

    stream = lifecycle.session_lifecycle(messages, closed_ms, idle_ms)
    writer = stream.writeStream.outputMode("append").foreachBatch(sink)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_lifecycle_in_batches(
    messages: DataFrame,
    sinks: dict,
    state: str,
    checkpoint: str,
    closed_ms: int = CLOSED_MS,
    idle_ms: int = IDLE_MS,
    buckets: int = versions.BUCKETS,
    **trigger,
):
    """The outputs of ``start_lifecycle``, with the sessions in a keyed table at ``state`` instead of a state store: no
    Python, no task per session, and bounded however it is triggered. A session is forgotten some batches after its time
    is over, as each batch looks over one of the ``buckets``."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batches.run_batch(batch, sinks, state, batch_id, closed_ms, idle_ms, buckets)
        finally:
            batch.unpersist()

    writer = messages.drop("message").writeStream.outputMode("append").foreachBatch(sink)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
