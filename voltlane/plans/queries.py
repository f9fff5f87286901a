"""Every operator as a query over the ``events`` table, for the driver's comparison."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.operators import epochs, filters, lines, pairing, quality, running, sessions, tables, topics, tracker
from voltlane.operators import retention as retained
from voltlane.operators import versions
from voltlane.plans import jobs, views
from voltlane.scratch import scratch_folder, staged
from voltlane.sources import events, history, logs, messages
from voltlane.streaming import job
from voltlane.streaming import pairing as live_pairing

AVERAGES = ["avgPower", "voltageAvg", "powerSum", "socAvg", "totalEnergy", "avgEnergy"]


def tidy(df: DataFrame) -> DataFrame:
    """Float sums rounded, as their order differs between engines; timestamps without a zone."""
    columns = []
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if field.name in AVERAGES:
            value = F.round(value, 6)
        if field.dataType.typeName() == "timestamp":
            value = value.cast("timestamp_ntz")
        columns.append(value.alias(field.name))
    return df.select(*columns)


# Inputs


def _as_of():
    return F.to_timestamp(F.lit("2024-01-31 00:00:00"))


def _events(spark, sf):
    return events.read_events(spark, sf)


def _records(spark, sf):
    return events.event_records(_events(spark, sf))


def _parsed(spark, sf):
    return lines.parse_lines(logs.content_lines(events.event_lines(_events(spark, sf))))


def _matched(spark, sf):
    return pairing.match_calls(_parsed(spark, sf))


def _typed(spark, sf):
    return jobs.typed_sessions(_records(spark, sf))


def _typed_table(spark, sf):
    """Typed messages written once, for what reads them more than once."""
    return staged(_typed(spark, sf), "typed")


def _history(spark, sf):
    return sessions.completed_sessions(_typed(spark, sf))


def _live_records(spark, sf):
    """Both live topics as one log: normalised messages, state after each message, a tombstone at each stop."""
    typed = _typed_table(spark, sf)
    live = topics.to_active_state(running.running_state_replay(typed, stage=False))
    stops = typed.filter("isStop").select(
        F.explode(F.array(F.lit(S.ACTIVE_TOPIC), F.lit(S.ACTIVE_RAW_TOPIC))).alias("topic"),
        F.col("sessionId").alias("key"),
        F.lit(None).cast("string").alias("value"),
        "offset",
    )
    return topics.to_active_raw(typed).unionByName(live).unionByName(stops)


def _history_table(spark, sf):
    return staged(_history(spark, sf), "history")


# Log lines and pairing


def read_log(spark, sf):
    folder = _written_log(spark, sf)
    read = logs.read_log(spark, folder)
    return read.groupBy(F.regexp_extract("file", r"file=(\d+)", 1).alias("file")).agg(F.count("*").alias("n"))


def _written_log(spark, sf):
    folder = scratch_folder(spark, "log")
    events.event_lines(_events(spark, sf)).select("file", "line").write.partitionBy("file").text(folder)
    return folder


def pairs_from_files(spark, sf):
    parsed = lines.parse_lines(logs.read_log(spark, _written_log(spark, sf)), python_literals=True)
    return pairing.pairs(pairing.match_calls(parsed)).select(
        "uniqueId", "chargerId", F.get_json_object("request", "$[2]").alias("action")
    )


def parse_flat(spark, sf):
    return lines.parse_flat(logs.content_lines(events.event_lines(_events(spark, sf)))).select("chargerId", "uniqueId")


def message_kinds(spark, sf):
    return _parsed(spark, sf).groupBy("chargerId", "kind").agg(F.count("*").alias("n"))


def reject_reasons(spark, sf):
    return lines.rejects(_parsed(spark, sf))


def pairs(spark, sf):
    return pairing.pairs(_matched(spark, sf)).select(
        "file", "uniqueId", "chargerId", F.get_json_object("request", "$[2]").alias("action")
    )


def unpaired_requests(spark, sf):
    return pairing.unpaired_requests(_matched(spark, sf)).select("file", "uniqueId", "chargerId")


def unpaired_responses(spark, sf):
    return pairing.unpaired_responses(_matched(spark, sf)).select("file", "uniqueId", "chargerId")


def request_has_response(spark, sf):
    return pairing.request_has_response(_matched(spark, sf)).select("uniqueId", "hasResponse")


def pairs_across_files(spark, sf):
    """Each request in another file than its response: pairs across files, and none within them."""
    parsed = _parsed(spark, sf).withColumn("file", F.concat("file", F.lit("-"), "kind"))

    def counted(scope):
        matched = pairing.match_calls(parsed, pair_scope=scope)
        return matched.groupBy(F.lit(scope).alias("scope"), "status").agg(F.count("*").alias("n"))

    return counted("global").unionByName(counted("file"))


def ingest_counts(spark, sf):
    return pairing.ingest_counts(pairing.outcomes(_parsed(spark, sf)))


def message_log(spark, sf):
    written = topics.to_message_log(_matched(spark, sf))
    return written.select("topic", "key", F.get_json_object("value", "$.chargerId").alias("chargerId"))


def recovered_transactions(spark, sf):
    written = topics.to_message_log(_matched(spark, sf), recover_transaction_id=True)
    fields = F.from_json("value", S.ENVELOPE)
    return written.select("key", fields["transactionId"].alias("transactionId")).filter("transactionId is not null")


def recovered_in_quotes(spark, sf):
    """Requests in single quotes; other actions mention a start, and their responses carry an id too."""
    matched = _matched(spark, sf)
    request = F.replace("request", F.lit('"MeterValues",{'), F.lit('"MeterValues",{"about":"StartTransaction",'))
    request = F.when(F.col("request").contains('"StartTransaction"'), F.replace("request", F.lit('"'), F.lit("'"))).otherwise(request)
    response = F.replace("response", F.lit("{}"), F.lit('{"transactionId":"of another action"}'))
    written = topics.to_message_log(
        matched.withColumns({"request": request, "response": response}), recover_transaction_id=True
    )
    fields = F.from_json("value", S.ENVELOPE)
    return written.select("key", fields["transactionId"].alias("transactionId")).filter("transactionId is not null")


def dead_letter_quoted(spark, sf):
    """Lone calls with their ids as old dead letters hold them."""
    letters = topics.to_dead_letter(pairing.outcomes(_parsed(spark, sf)), legacy_quoted_id=True)
    read = letters.select(F.from_json("value", "chargerId STRING, uniqueId STRING, reason STRING").alias("v")).select("v.*")
    return read.filter("uniqueId is not null")


def dead_letter(spark, sf):
    letters = topics.to_dead_letter(pairing.outcomes(_parsed(spark, sf)))
    fields = "chargerId STRING, uniqueId STRING, line STRING, reason STRING"
    return letters.select("topic", F.from_json("value", fields).alias("v")).select("topic", "v.*")


def last_per_key(spark, sf):
    newest = tables.last_per_key(_events(spark, sf), ["user_id"], "event_id")
    return newest.select("user_id", "event_id", "event_type", "value")


# Decoding


def decode_envelope(spark, sf):
    return messages.decode_envelope(_records(spark, sf)).select("topic", "offset", "uniqueId", "chargerId")


def decode_typed(spark, sf):
    return messages.decode_messages(_records(spark, sf)).drop("message")


def decode_strict_millis(spark, sf):
    """Every fourth call with three digits in its fractions, the others with six."""
    short = F.regexp_replace("value", r"(\.\d{3})\d{3}(Z|\+05:30)", "$1$2")
    records = _records(spark, sf).withColumn("value", F.when(F.col("offset") % 4 == 0, short).otherwise(F.col("value")))
    typed = messages.decode_messages(records, strict_millis=True)
    return typed.groupBy("action").agg(F.count("*").alias("n"), F.count("eventTime").alias("timed"))


def decode_literals(spark, sf):
    typed = messages.decode_messages(events.literal_records(_events(spark, sf)), python_literals=True)
    return typed.select("offset", "uniqueId", "action", "idTag", "connectorId")


def _mixed_records(spark, sf):
    """The topic with every third call as a Python literal and every third with escapes in its action."""
    message = F.col("v.message")
    literal = F.regexp_replace(message, r'^(\[2,"[^"]*","[^"]*",)\{', '$1{"none": None, "ok": True, ')
    escaped = message
    for plain, spelt in (("Transaction", "Tr\\u0061nsaction"), ("Values", "V\\u0061lues"), ("StatusN", "St\\u0061tusN")):
        escaped = F.replace(escaped, F.lit(plain + '",'), F.lit(spelt + '",'))
        escaped = F.replace(escaped, F.lit('"' + plain), F.lit('"' + spelt))
    by = F.when(F.col("offset") % 3 == 0, literal).when(F.col("offset") % 3 == 1, escaped).otherwise(message)
    read = _records(spark, sf).withColumn("v", F.from_json("value", S.ENVELOPE))
    return read.withColumn("value", F.to_json(F.struct("v.chargerId", "v.uniqueId", by.alias("message")))).drop("v")


def completed_from_mixed(spark, sf):
    return sessions.completed_sessions(jobs.typed_sessions(_mixed_records(spark, sf)))


def status_from_mixed(spark, sf):
    return messages.decode_status(_mixed_records(spark, sf))


def number_kinds(spark, sf):
    """Meter readings with a fraction: numbers lose it, texts are no whole numbers."""
    odd = F.regexp_replace("value", r'(meterStart\\?":)(\d+)', "$1$2.7")
    text = F.regexp_replace("value", r'(meterStart\\?":)(\d+)', '$1\\\\"$2.7\\\\"')
    value = F.when(F.col("offset") % 2 == 0, text).otherwise(odd)
    typed = messages.decode_messages(_records(spark, sf).withColumn("value", value))
    return typed.filter(F.col("action") == S.START).select("offset", "meterStart")


def session_messages(spark, sf):
    return _typed(spark, sf).select("offset", "sessionId", "action", "isStop")


def active_and_stop_messages(spark, sf):
    typed = _typed_table(spark, sf)
    part = lambda df, name: df.select(F.lit(name).alias("branch"), "sessionId", "offset")
    return part(filters.active_messages(typed), "active").unionByName(part(filters.stop_messages(typed), "stop"))


def meter_samples(spark, sf):
    return messages.decode_samples(_records(spark, sf)).drop("uniqueId", "chargerId")


def sample_pivot(spark, sf):
    wide = messages.pivot_samples(messages.decode_samples(_records(spark, sf)))
    return wide.select("offset", "transactionId", F.col("`Power.Active.Import`").alias("power"), "Voltage", "SoC")


def status_rows(spark, sf):
    return messages.decode_status(_records(spark, sf))


def normalized_raw(spark, sf):
    written = topics.to_active_raw(_typed(spark, sf))
    read = written.select("topic", "key", "offset", F.from_json("value", S.ACTIVE_RAW).alias("v"))
    return read.select("topic", "key", "offset", "v.stationId", "v.timestamp", "v.action", "v.value.*")


# Sessions


def session_aggregate(spark, sf):
    return sessions.session_aggregate(_typed(spark, sf))


def completed_sessions(spark, sf):
    return _history(spark, sf)


def completed_stop_only(spark, sf):
    done = sessions.completed_sessions(_typed(spark, sf), stop_actions=[S.STOP], soc_by_time=True)
    return done.select("sessionId", "endTime", "duration", "socStart", "socEnd")


def completed_by_epoch(spark, sf):
    done = sessions.completed_sessions(_typed(spark, sf), epoch=True)
    return done.select("sessionId", "startTime", "endTime", "duration", "eventCount")


def session_epochs(spark, sf):
    rows = epochs.with_epoch(
        _typed(spark, sf), ["chargerId", "transactionId"], F.col("isStop"), rows_per_block=1000
    )
    return rows.select("offset", "sessionId", "epoch")


def epochs_of_partitions(spark, sf):
    """The topic as a file with two partitions, whose offsets overlap."""
    folder = scratch_folder(spark, "partitions")
    split = {"partition": (F.col("offset") % 2).cast("int"), "offset": F.expr("offset div 2")}
    _records(spark, sf).withColumns(split).write.parquet(folder)
    typed = jobs.typed_sessions(messages.read_messages_batch(spark, folder, "parquet"))
    rows = epochs.with_epoch(typed, ["chargerId", "transactionId"], F.col("isStop"))
    n = messages.PARTITIONS
    return rows.select(F.expr(f"offset div {n} * 2 + offset % {n}").alias("offset"), "sessionId", "epoch")


def first_event_time(spark, sf):
    rows = running.with_first_event_time(_typed(spark, sf), rows_per_block=1000)
    return rows.select("offset", "sessionStart", "startSessionId")


def running_state(spark, sf):
    return running.running_state(_typed(spark, sf))


def running_state_replay(spark, sf):
    return running.running_state_replay(_typed(spark, sf), rows_per_block=1000)


def running_state_by_time(spark, sf):
    """Messages arrive backwards within groups of eight."""
    turned = F.expr("offset div 8 * 8 + 7 - offset % 8")
    typed = _typed(spark, sf).withColumn("offset", turned)
    return running.running_state_replay(typed, order="event_time").withColumn("offset", turned)


def distinct_sessions(spark, sf):
    return views.distinct_sessions(_typed(spark, sf))


def track_sessions(spark, sf):
    return tracker.track_sessions(messages.decode_payloads(_records(spark, sf)), rows_per_block=1000)


def track_sessions_open(spark, sf):
    payloads = messages.decode_payloads(_records(spark, sf))
    return tracker.track_sessions(payloads, key=("transactionId",), include_open=True)


def session_status(spark, sf):
    return sessions.session_status(_typed(spark, sf))


def trapezoid_energy(spark, sf):
    return sessions.trapezoid_energy(_typed(spark, sf))


# Topics


def active_overview(spark, sf):
    live = views.active_overview(_live_records(spark, sf))
    return live.withColumns({c: F.col(c).cast("timestamp") for c in ("startTime", "lastSeen")})


def compacted_view(spark, sf):
    return topics.compacted_view(_live_records(spark, sf)).select("topic", "key", "offset")


def compacted_incremental(spark, sf):
    """Both live topics, whose log grows in four parts; after each the compacted table takes what is new, one part twice."""
    log = staged(_live_records(spark, sf), "log")
    path = scratch_folder(spark, "compacted")
    last = log.agg(F.max("offset")).first()[0]
    for part in (1, 2, 2, 3, 4):
        jobs.keep_compacted(log.filter(F.col("offset") <= last * part // 4), path)
    return topics.compacted_table(spark, path).select("topic", "key", "offset")


def raw_after_tombstone(spark, sf):
    rows = topics.after_last_tombstone(_live_records(spark, sf), rows_per_block=1000, stage=True)
    return rows.select("topic", "key", "offset")


def tombstones(spark, sf):
    return topics.to_tombstones(filters.stop_messages(_typed(spark, sf))).select("topic", "key", "value", "offset")


def retention(spark, sf):
    return filters.retained(_typed(spark, sf), "eventTime", _as_of(), 3).select("offset", "sessionId", "eventTime")


def retention_purged(spark, sf):
    """The live messages as a table by day, written in two batches and purged twice; limits fall inside a day."""
    typed = _typed_table(spark, sf)
    path = scratch_folder(spark, "days")
    for batch in range(2):
        retained.write_days(typed.filter(F.col("offset") % 2 == batch), path, batch_id=batch)
    for hours in (-20, 9):
        retained.purge(spark, path, _as_of() + F.make_dt_interval(hours=F.lit(hours)), 3)
    return spark.read.parquet(path).select("offset", "sessionId", "eventTime", F.col("day").cast("string").alias("day"))


def live_log_of_charger(spark, sf):
    raw = topics.to_active_raw(_typed(spark, sf))
    return views.session_messages(raw, "charger6_", end=_as_of() - F.expr("INTERVAL 7 DAYS")).select("key", "offset")


# Views


def energy_by_station(spark, sf):
    return views.energy_by_station(_history(spark, sf), _as_of(), 14)


def termination_stats(spark, sf):
    return views.termination_stats(_history(spark, sf))


def station_sessions(spark, sf):
    return views.station_sessions(_history(spark, sf), "charger6", _as_of(), 7)


def sessions_by_day_station(spark, sf):
    return views.sessions_by(_history(spark, sf), "day", ("stationId",))


def sessions_by_week(spark, sf):
    return views.sessions_by(_history(spark, sf), "week", ())


def sessions_by_each(spark, sf):
    return views.sessions_by_each(_history(spark, sf), ("day", "week"), ("stationId",))


def station_health(spark, sf):
    return views.station_health(messages.decode_status(_records(spark, sf)))


def last_heartbeat(spark, sf):
    return views.last_heartbeat(_parsed(spark, sf))


def all_chargers(spark, sf):
    return views.all_chargers(messages.decode_envelope(_records(spark, sf)))


def all_actions(spark, sf):
    return views.all_actions(messages.decode_calls(_records(spark, sf)))


def charger_payloads(spark, sf):
    rows = views.charger_payloads(messages.decode_calls(_records(spark, sf)), "charger6")
    return rows.select("uniqueId", "action", F.get_json_object("payload", "$.transactionId").alias("transactionId"))


def lookup(spark, sf):
    return views.lookup(_history(spark, sf), stationId="charger6", terminationReason="HardReset")


def newest_sessions(spark, sf):
    return views.newest_sessions(_history(spark, sf), 10)


def _live_and_stopped(typed):
    """Live state that still holds every third of the completed sessions."""
    done = sessions.completed_sessions(typed).filter(F.col("duration") % 3 == 0)
    stale = done.withColumns(
        {"status": F.lit("active"), "energyConsumedSoFar": F.lit(-1.0), "runningCount": F.lit(-1).cast("long")}
    )
    live = running.running_state(typed)
    return live.unionByName(stale.select(*live.columns))


def active_history_bridge(spark, sf):
    typed = _typed_table(spark, sf)
    return views.bridge(_live_and_stopped(typed), sessions.completed_sessions(typed))


# Table maintenance


def _corrections(done):
    """Sessions of odd-numbered stations with a new reason, and as many new ones."""
    odd = done.filter(F.col("stationId").rlike("[13579]$")).withColumn("terminationReason", F.lit("corrected"))
    fresh = odd.withColumn("sessionId", F.concat("sessionId", F.lit("_new")))
    return odd.unionByName(fresh)


def history_upsert(spark, sf):
    done = _history_table(spark, sf)
    return tables.upsert(done, _corrections(done)).select("sessionId", "terminationReason", "eventCount")


def history_upsert_repeated(spark, sf):
    """Every update twice; the one of the higher reason counts."""
    done = _history_table(spark, sf)
    updates = _corrections(done)
    both = updates.unionByName(updates.withColumn("terminationReason", F.lit("a draft")))
    return tables.upsert(done, both, order="terminationReason").select("sessionId", "terminationReason", "eventCount")


def history_by_day(spark, sf):
    """Two batches, the second with corrections, compacted by day and read again through a view of some days."""
    done = _history_table(spark, sf)
    path, daily = scratch_folder(spark, "history"), scratch_folder(spark, "daily")
    tables.write_batch(done.withColumn("totalEnergyConsumed", F.lit(0.0)), path, 0)
    tables.write_batch(done, path, 1)
    tables.compact_batches(spark, path, daily)
    return views.energy_by_station(history.read_history(spark, daily), _as_of(), 14)


def history_plain(spark, sf):
    folder = scratch_folder(spark, "plain")
    _history(spark, sf).write.parquet(folder)
    return history.read_history(spark, folder)


def history_upsert_skip(spark, sf):
    done = _history_table(spark, sf)
    return tables.upsert(done, _corrections(done), on_conflict="skip").select("sessionId", "terminationReason")


def history_update(spark, sf):
    hit = F.col("terminationReason") == "HardReset"
    changes = {"terminationReason": F.lit("Reset"), "eventCount": F.col("eventCount") + 1}
    return tables.update_rows(_history(spark, sf), hit, changes).select("sessionId", "terminationReason", "eventCount")


def history_delete(spark, sf):
    done = _history_table(spark, sf)
    kept = tables.delete_keys(done, _corrections(done), "sessionId")
    return tables.delete_rows(kept, F.col("terminationReason") == "SoftReset").select("sessionId", "terminationReason")


def history_versions(spark, sf):
    """A keyed table that three batches are applied to, the second one twice, of which only the newest files are left."""
    done = _history_table(spark, sf)
    path = scratch_folder(spark, "versions")
    batches = [done.withColumn("terminationReason", F.lit("draft")).filter("duration % 2 = 0"), done, _corrections(done)]
    for number, rows in [(0, batches[0]), (1, batches[1]), (1, batches[0]), (2, batches[2])]:
        versions.apply_batch(rows, path, number)
    versions.vacuum(spark, path)
    return versions.read_versions(spark, path).select("sessionId", "terminationReason", "eventCount")


def history_defaults(spark, sf):
    done = _history(spark, sf).select("sessionId", "stationId", "transactionId", "startTime", "endTime", "duration")
    return tables.aligned(done).select("sessionId", "duration", "terminationReason", "meterStart", "eventCount")


def history_written(spark, sf):
    """Two batches written as table versions, the first one twice, then read back and compacted."""
    done = _history_table(spark, sf)
    path, daily = scratch_folder(spark, "history"), scratch_folder(spark, "daily")
    tables.write_batch(done, path, 0)
    tables.write_batch(done, path, 0)
    tables.write_batch(_corrections(done), path, 1)
    tables.compact_table(history.read_history(spark, path), daily)
    return spark.read.parquet(daily).select("sessionId", "terminationReason", "startTime", "eventCount")


def history_exported(spark, sf):
    path = scratch_folder(spark, "export")
    tables.export(_history(spark, sf), path, "json")
    fields = "sessionId STRING, status STRING, duration INT, totalEnergyConsumed STRUCT<value: DOUBLE, unit: STRING>"
    return spark.read.schema(fields).json(path).select("sessionId", "status", "duration", "totalEnergyConsumed.*")


def charger_session_table(spark, sf):
    tracked = tracker.track_sessions(messages.decode_payloads(_records(spark, sf)))
    return tables.aligned(tracked, S.CHARGER_SESSION)


def charger_sessions_kept(spark, sf):
    """The same with one row per session, applied as a batch that is repeated."""
    path = scratch_folder(spark, "charger-sessions")
    for _ in range(2):
        jobs.keep_charger_sessions(_records(spark, sf), path, 0)
    return versions.read_versions(spark, path)


# Quality checks


def dq_required(spark, sf):
    done = _history(spark, sf)
    broken = tables.update_rows(done, F.col("duration") % 7 == 0, {"endTime": F.lit(None).cast("timestamp")})
    return quality.required_nulls(broken)


def dq_meter(spark, sf):
    return quality.meter_order(_history(spark, sf)).select("sessionId", "meterStart", "meterStop")


def dq_energy(spark, sf):
    shifted = {"totalEnergyConsumed": F.col("totalEnergyConsumed") + 1}
    broken = tables.update_rows(_history(spark, sf), F.col("duration") % 5 == 0, shifted)
    return quality.energy_mismatch(broken).select("sessionId")


def dq_duration(spark, sf):
    broken = tables.update_rows(_history(spark, sf), F.col("duration") % 5 == 0, {"duration": F.col("duration") + 2})
    return quality.duration_mismatch(broken).select("sessionId", "duration")


def dq_exclusive(spark, sf):
    typed = _typed_table(spark, sf)
    return quality.active_and_completed(_live_and_stopped(typed), sessions.completed_sessions(typed))


def dq_status(spark, sf):
    broken = tables.update_rows(_history(spark, sf), F.col("duration") % 5 == 0, {"status": F.lit("active")})
    return quality.not_completed(broken).select("sessionId", "status")


# Streams. Each reads a file-backed topic that Spark derives from the events.


def _topic_files(spark, sf, parts: int) -> str:
    """The message topic as a folder of Parquet files."""
    folder = scratch_folder(spark, "topic")
    _records(spark, sf).repartition(parts, "key").write.parquet(folder)
    return folder


def _typed_stream(spark, folder, **options):
    return jobs.typed_sessions(messages.read_messages_stream(spark, folder, "parquet", **options))


def _session_job(spark, sf) -> str:
    out = scratch_folder(spark, "live")
    stream = _typed_stream(spark, _topic_files(spark, sf, 4), maxFilesPerTrigger=2)
    job.use_rocksdb(spark)
    job.start_sessions(stream, job.file_sinks(out), out + "/checkpoint", availableNow=True).awaitTermination()
    return out


def stream_history(spark, sf):
    return history.read_history(spark, _session_job(spark, sf) + "/history")


def stream_history_once(spark, sf):
    """The live job into a keyed table, each batch applied once; the table holds one row per session."""
    out = scratch_folder(spark, "live")
    stream = _typed_stream(spark, _topic_files(spark, sf, 4), maxFilesPerTrigger=2)
    job.use_rocksdb(spark)
    sinks = job.file_sinks(out) | {"history": job.versioned_sink(out + "/versions", buckets=8)}
    job.start_sessions(stream, sinks, out + "/checkpoint", availableNow=True).awaitTermination()
    return versions.read_versions(spark, out + "/versions")


def stream_active(spark, sf):
    live = views.active_overview(spark.read.parquet(_session_job(spark, sf) + "/live"))
    return live.withColumns({c: F.col(c).cast("timestamp") for c in ("startTime", "lastSeen")})


def stream_lifecycle(spark, sf):
    """The event table arrives in four parts by day of month; the job is restarted for each from its checkpoint."""
    folder, out = scratch_folder(spark, "topic"), scratch_folder(spark, "lifecycle")
    job.use_rocksdb(spark)
    records = _records(spark, sf)
    for part in range(4):
        arrived = records.filter(F.floor((F.dayofmonth("timestamp") - 1) / 8) == part)
        arrived.write.mode("append").parquet(folder)
        stream = _typed_stream(spark, folder)
        job.start_lifecycle(stream, job.file_sinks(out), out + "/checkpoint", availableNow=True).awaitTermination()
    done = history.read_history(spark, out + "/history").select("sessionId", "startTime", "endTime", "eventCount")
    late = spark.read.parquet(out + "/late").groupBy(F.col("key").alias("sessionId")).agg(F.count("*").alias("late"))
    return done.join(late, "sessionId", "left").withColumn("late", F.coalesce("late", F.lit(0)))


def stream_lifecycle_batches(spark, sf):
    """The same parts through the job that keeps sessions in a keyed table."""
    folder, out = scratch_folder(spark, "topic"), scratch_folder(spark, "lifecycle")
    records = _records(spark, sf)
    for part in range(4):
        arrived = records.filter(F.floor((F.dayofmonth("timestamp") - 1) / 8) == part)
        arrived.write.mode("append").parquet(folder)
        start = job.start_lifecycle_in_batches
        stream = _typed_stream(spark, folder)
        start(stream, job.file_sinks(out), out + "/state", out + "/checkpoint", buckets=8, availableNow=True).awaitTermination()
    done = history.read_history(spark, out + "/history").select("sessionId", "startTime", "endTime", "eventCount")
    late = spark.read.parquet(out + "/late").groupBy(F.col("key").alias("sessionId")).agg(F.count("*").alias("late"))
    return done.join(late, "sessionId", "left").withColumn("late", F.coalesce("late", F.lit(0)))


def _ingested(spark, sf) -> str:
    """The log as a stream to both topics; the arrival time of a line is that of its event, and a last line much later
    lets all the others out."""
    folder, out = scratch_folder(spark, "lines"), scratch_folder(spark, "ingest")
    source = logs.content_lines(events.event_lines(_events(spark, sf)))
    arrival = F.timestamp_seconds(F.lit(1704067200) + F.expr("ord div 8"))
    rows = source.select("file", "ord", "line", arrival.alias("arrival"))
    rows.write.parquet(folder)
    last = rows.agg(F.max("arrival").alias("arrival")).select(
        F.lit("last").alias("file"),
        F.lit(0).cast("long").alias("ord"),
        F.lit('clock : [2,"last","Heartbeat",{}]').alias("line"),
        (F.col("arrival") + F.expr("INTERVAL 1 DAY")).alias("arrival"),
    )
    last.write.mode("append").parquet(folder)
    live = spark.readStream.schema(rows.schema).parquet(folder)
    sinks = {name: lambda df, i, name=name: tables.write_batch(df, f"{out}/{name}", i) for name in ("messages", "dead")}
    parsed = lines.parse_lines(live)
    live_pairing.start_ingest(parsed, sinks, out + "-checkpoint", availableNow=True).awaitTermination()
    return out


def stream_pairs(spark, sf):
    """Requests and responses matched on a stream."""
    written = spark.read.parquet(_ingested(spark, sf) + "/messages")
    return written.select(F.col("key").alias("uniqueId"), F.get_json_object("value", "$.chargerId").alias("chargerId"))


def stream_dead_letters(spark, sf):
    letters = spark.read.parquet(_ingested(spark, sf) + "/dead")
    fields = "chargerId STRING, uniqueId STRING, line STRING, reason STRING"
    return letters.select("topic", F.from_json("value", fields).alias("v")).select("topic", "v.*")


def _live_log(spark, sf, old: str | None = None):
    """The charger log as text files, one folder per day, and its lines, parsed once by a stream, as a stream. A last line,
    a day later, lets all the others out. ``old`` is a day whose files are a week old."""
    folder = _written_log(spark, sf)
    closing = F.lit('clock : [2,"last","Heartbeat",{}]')
    spark.range(1).select(closing).write.text(f"{folder}/file=closing")
    if old is not None:
        files = retained.Files(spark, folder)
        for status in files.system.listStatus(files.at(f"file={old}")):
            files.system.setTimes(status.getPath(), status.getModificationTime() - 7 * 86_400_000, -1)
    kept = scratch_folder(spark, "parsed")
    parsed = lines.parse_lines(logs.read_log_stream(spark, folder))
    logs.keep_parsed(parsed, kept, kept + "-checkpoint", availableNow=True).awaitTermination()
    day = F.when(F.col("file").contains("closing"), 1).otherwise(0)
    return logs.read_parsed_stream(spark, kept, clock=F.current_timestamp() + F.make_dt_interval(day))


def stream_log_pairs(spark, sf):
    """Pairs of log files that arrive as a stream, where a file may repeat a request with another action."""
    out = scratch_folder(spark, "ingest")
    sinks = {name: lambda df, i, name=name: tables.write_batch(df, f"{out}/{name}", i) for name in ("messages", "dead")}
    live_pairing.start_ingest(_live_log(spark, sf), sinks, out + "-checkpoint", availableNow=True).awaitTermination()
    message = F.get_json_object("value", "$.message")
    return spark.read.parquet(out + "/messages").select(
        F.col("key").alias("uniqueId"),
        F.get_json_object("value", "$.chargerId").alias("chargerId"),
        F.get_json_object(message, "$[2]").alias("action"),
    )


def stream_log_accounted(spark, sf):
    """Requests and responses joined as two streams, one day's files being late: rows and different lines by status."""
    out = scratch_folder(spark, "joined")
    live_pairing.use_one_clock(spark)
    job.use_rocksdb(spark)
    # Counting the rows of the state looks each key up once more when it is written.
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    try:
        joined = live_pairing.join_stream(_live_log(spark, sf, old="20240105"), late_after="2 days")
        writer = joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")
        spark.conf.unset("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows")
    rows = spark.read.parquet(out).filter("chargerId is null or chargerId <> 'clock'")
    places = rows.select("status", F.explode("places").alias("place")).distinct().groupBy("status")
    return rows.groupBy("status").agg(F.count("*").alias("n")).join(places.agg(F.count("*").alias("lines")), "status")


ALL = [
    read_log, pairs_from_files, parse_flat, message_kinds, reject_reasons, pairs, unpaired_requests,
    unpaired_responses, request_has_response, pairs_across_files, ingest_counts, message_log,
    recovered_transactions, dead_letter, last_per_key, decode_envelope, decode_typed, decode_strict_millis,
    decode_literals, session_messages, active_and_stop_messages, meter_samples, sample_pivot, status_rows,
    normalized_raw, session_aggregate, completed_sessions, completed_stop_only, completed_by_epoch,
    session_epochs, first_event_time, running_state, running_state_replay, running_state_by_time,
    distinct_sessions, track_sessions, track_sessions_open, session_status, trapezoid_energy, active_overview,
    compacted_view, raw_after_tombstone, tombstones, retention, live_log_of_charger, energy_by_station,
    termination_stats, station_sessions, sessions_by_day_station, sessions_by_week, station_health,
    last_heartbeat, all_chargers, all_actions, charger_payloads, lookup, newest_sessions,
    active_history_bridge, history_upsert, history_upsert_skip, history_update, history_delete,
    history_defaults, history_written, history_exported, charger_session_table, dq_required, dq_meter,
    dq_energy, dq_duration, dq_exclusive, dq_status, stream_history, stream_active, stream_lifecycle,
    stream_pairs, stream_dead_letters, completed_from_mixed, status_from_mixed, number_kinds, epochs_of_partitions,
    recovered_in_quotes, history_upsert_repeated, history_by_day, history_plain, retention_purged,
    stream_log_pairs, stream_log_accounted, compacted_incremental, dead_letter_quoted, sessions_by_each,
    history_versions, charger_sessions_kept, stream_history_once, stream_lifecycle_batches,
]


def _ready(query):
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return tidy(query(spark, sf_dir))

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def registry():
    return {query.__name__: _ready(query) for query in ALL}
