"""The same results as SQL over the ``events`` table, worked out from its columns without any message text."""

_M = """
m AS (
  SELECT event_id, user_id, ts, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
    'charger' || (user_id % 10) AS chargerId,
    CASE WHEN event_id % 13 = 0 THEN '20240101T' || event_id || 'Z' ELSE 'm-' || event_id END AS uniqueId,
    CASE WHEN event_id % 13 = 0 THEN '20240101 ' || event_id || 'Z' ELSE 'm-' || event_id END AS spacedId,
    strftime(ts, '%Y%m%d') AS file,
    CASE WHEN event_id % 14 = 0 THEN 'StatusNotification' WHEN event_id % 7 = 0 THEN 'Heartbeat'
         WHEN event_type = 'signup' THEN 'StartTransaction' WHEN event_type = 'purchase' THEN 'StopTransaction'
         WHEN event_type = 'error' THEN 'RemoteStopTransaction' ELSE 'MeterValues' END AS action,
    CASE WHEN user_id % 4 = 0
         THEN CAST(user_id * 100000000 + CAST(strftime(date_trunc('week', ts), '%Y%m%d') AS BIGINT) AS VARCHAR)
         ELSE user_id || '_' || strftime(date_trunc('week', ts), '%Y%m%d') END AS txn,
    CASE WHEN event_id % 6 = 1 THEN strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS stamp
  FROM events
)"""

# One row per event with the columns of a typed message.
_T = (
    _M
    + """,
typed AS (
  SELECT 'ocpp.messages' AS topic, event_id AS "offset", uniqueId, chargerId, action,
    CASE WHEN action NOT IN ('Heartbeat', 'StatusNotification') THEN txn END AS transactionId,
    CASE WHEN action <> 'Heartbeat' THEN stamp END AS timestamp_str,
    CASE WHEN action = 'MeterValues' THEN value END AS power,
    CASE WHEN action = 'StartTransaction' THEN event_id END AS meterStart,
    CASE WHEN action = 'StopTransaction' THEN event_id END AS meterStop,
    CASE WHEN action = 'StartTransaction' THEN 'tag' || user_id END AS idTag,
    CASE WHEN action IN ('MeterValues', 'StartTransaction', 'StatusNotification')
         THEN CAST(1 + user_id % 2 AS INTEGER) END AS connectorId,
    CASE WHEN action = 'MeterValues' THEN CAST(k AS DOUBLE) END AS soc,
    CASE WHEN action = 'MeterValues' AND event_id % 19 <> 0 THEN CAST(220 + k % 20 AS DOUBLE) END AS voltage,
    CASE WHEN action = 'StopTransaction'
         THEN ['EVDriverDisconnected', 'EmergencyStop', 'HardReset', 'SoftReset'][event_id % 4 + 1] END AS reason,
    CASE WHEN action <> 'Heartbeat' THEN ts END AS eventTime,
    CASE WHEN action IN ('Heartbeat', 'StatusNotification') THEN chargerId ELSE chargerId || '_' || txn END AS sessionId,
    action IN ('StopTransaction', 'RemoteStopTransaction') AS isStop
  FROM m
),
s AS (SELECT * FROM typed WHERE transactionId IS NOT NULL)"""
)


def _sessions(stops="'StopTransaction', 'RemoteStopTransaction'"):
    return f"""
agg AS (
  SELECT chargerId, transactionId, sessionId, min(eventTime) AS startTime,
    max(CASE WHEN action IN ({stops}) THEN eventTime END) AS endTime, count(*) AS eventCount,
    max(reason) AS terminationReason, sum(power) AS powerSum, count(power) AS powerCount,
    max(meterStart) AS meterStart, max(meterStop) AS meterStop, max(idTag) AS idTag,
    max(CASE WHEN action = 'StartTransaction' THEN connectorId END) AS connectorId,
    min(soc) AS socStart, max(soc) AS socEnd, avg(soc) AS socAvg, max(power) AS maxPower,
    avg(voltage) AS voltageAvg, min(voltage) AS voltageMin, max(voltage) AS voltageMax,
    arg_min(soc, eventTime) AS socFirst, arg_max(soc, eventTime) AS socLast
  FROM s GROUP BY chargerId, transactionId, sessionId
),
done AS (
  SELECT *, CAST(floor(epoch(endTime)) - floor(epoch(startTime)) AS INTEGER) AS duration,
    powerSum / powerCount AS rawPower
  FROM agg WHERE endTime IS NOT NULL
),
history AS (
  SELECT sessionId, chargerId AS stationId, transactionId, 'completed' AS status, startTime, endTime, duration,
    endTime AS lastSeen, terminationReason, CAST(round(CAST(rawPower * (duration / 3600.0) AS DECIMAL(30, 9)), 3) AS DOUBLE) AS totalEnergyConsumed,
    rawPower AS avgPower, maxPower, idTag, connectorId, meterStart, meterStop, socStart, socEnd, voltageAvg, eventCount
  FROM done
)"""


_H = _T + "," + _sessions()

_HISTORY_COLUMNS = """sessionId, stationId, transactionId, status, startTime, endTime, duration, lastSeen,
  terminationReason, totalEnergyConsumed, round(avgPower, 6) AS avgPower, maxPower, idTag, connectorId, meterStart,
  meterStop, socStart, socEnd, round(voltageAvg, 6) AS voltageAvg, eventCount"""

_LINES = (
    _M
    + """,
requests AS (SELECT * FROM m),
answered AS (SELECT * FROM m WHERE event_id % 10 <> 0),
orphans AS (SELECT *, 'orphan-' || event_id AS orphanId FROM m WHERE event_id % 17 = 0),
junk AS (
  SELECT event_id, chargerId,
    CASE event_id % 5 WHEN 0 THEN chargerId || ' [2,"x' || event_id || '","Heartbeat",{ }]'
      WHEN 1 THEN chargerId || ' : [2]'
      WHEN 2 THEN chargerId || ' : [2,"x' || event_id || '","Heartbeat"{ }]'
      WHEN 3 THEN chargerId || ' : [9,"x' || event_id || '","Heartbeat",{}]'
      ELSE chargerId || ' : {"x":' || event_id || '}' END AS line,
    ['regex match failed', 'message too short', 'JSON/ast parsing failed', 'unknown message type: 9',
     'not an array'][event_id % 5 + 1] AS reason
  FROM m WHERE event_id % 23 = 0
)"""
)

_SAMPLES = (
    _T
    + """,
parts AS (
  SELECT event_id, txn, value, k, ts, 0 AS entry FROM m WHERE action = 'MeterValues'
  UNION ALL SELECT event_id, txn, value + 1, k, ts + INTERVAL 30 SECOND, 1 FROM m
  WHERE action = 'MeterValues' AND event_id % 5 = 0
),
samples AS (
  SELECT event_id AS "offset", txn AS transactionId, entry, ts AS sampleTime, 'Power.Active.Import' AS measurand,
    'kW' AS unit, value, CASE WHEN entry = 0 AND event_id % 11 = 0 THEN 1 ELSE 0 END AS "position" FROM parts
  UNION ALL SELECT event_id, txn, 0, ts, 'Power.Active.Import', 'kW', NULL, 0 FROM parts
  WHERE entry = 0 AND event_id % 11 = 0
  UNION ALL SELECT event_id, txn, 0, ts, CASE WHEN event_id % 2 = 0 THEN 'Battery.SOC' ELSE 'SoC' END, 'Percent',
    CAST(k AS DOUBLE), CASE WHEN event_id % 11 = 0 THEN 2 ELSE 1 END FROM parts WHERE entry = 0
  UNION ALL SELECT event_id, txn, 0, ts, 'Voltage', 'V',
    CASE WHEN event_id % 19 <> 0 THEN CAST(220 + k % 20 AS DOUBLE) END,
    CASE WHEN event_id % 11 = 0 THEN 3 ELSE 2 END FROM parts WHERE entry = 0
)"""
)


def _tracked(keys, station):
    """The older consumer's sessions: a new one after every StopTransaction."""
    return f"""
calls AS (
  SELECT event_id, chargerId, action, CASE WHEN action IN ('Heartbeat', 'StatusNotification') THEN uniqueId ELSE txn
    END AS transactionId, ts, value, event_id % 5 = 0 AS twice,
    ['EVDriverDisconnected', 'EmergencyStop', 'HardReset', 'SoftReset'][event_id % 4 + 1] AS why,
    coalesce(sum(CASE WHEN action = 'StopTransaction' THEN 1 ELSE 0 END) OVER (
      PARTITION BY {keys.replace("transactionId", "txn_key")} ORDER BY event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS epoch
  FROM (SELECT *, CASE WHEN action IN ('Heartbeat', 'StatusNotification') THEN uniqueId ELSE txn END AS txn_key FROM m)
),
tracked AS (
  SELECT {keys}, epoch, bool_or(action = 'StopTransaction') AS closed, {station} AS station,
    min(CASE WHEN action = 'MeterValues' THEN ts END) AS startTime,
    coalesce(max(CASE WHEN action = 'StopTransaction' THEN ts END),
      arg_max(CASE WHEN twice THEN ts + INTERVAL 30 SECOND ELSE ts END, event_id)
        FILTER (WHERE action = 'MeterValues')) AS endTime,
    sum(CASE WHEN action = 'MeterValues' THEN CASE WHEN twice THEN 2 * value + 1 ELSE value END END) AS powerSum,
    sum(CASE WHEN action = 'MeterValues' THEN CASE WHEN twice THEN 2 ELSE 1 END END) AS powerCount,
    count(CASE WHEN action IN ('MeterValues', 'StopTransaction', 'StatusNotification', 'Heartbeat') THEN 1 END)
      AS eventCount,
    max(CASE WHEN action = 'StopTransaction' THEN why END) AS terminationReason
  FROM calls GROUP BY {keys}, epoch
),
tracked_rows AS (
  SELECT closed, station || '_' || coalesce(strftime(startTime, '%Y-%m-%dT%H:%M:%S') ||
      CASE WHEN epoch_us(startTime) % 1000000 = 0 THEN '' ELSE strftime(startTime, '.%f') END || '+00:00', 'unknown')
      AS sessionId,
    station AS stationId, CASE WHEN closed THEN 'ended' END AS status, terminationReason, startTime, endTime,
    CASE WHEN powerCount > 0 THEN CAST(trunc((epoch_us(endTime) - epoch_us(startTime)) / 1e6) AS INTEGER) END
      AS duration,
    CASE WHEN powerCount > 0 THEN
      CAST(round(CAST(powerSum / powerCount * ((epoch_us(endTime) - epoch_us(startTime)) / 1e6 / 3600) AS DECIMAL(30, 9)), 3) AS DOUBLE) END
      AS totalEnergyConsumed,
    eventCount
  FROM tracked
)"""


_STATE = """sessionId, chargerId AS stationId, transactionId,
  CASE WHEN runningCount > 0 THEN 'active' ELSE 'pending' END AS status, startTime, lastSeen,
  CAST(floor(epoch(lastSeen)) - floor(epoch(startTime)) AS INTEGER) AS duration,
  CASE WHEN powerCount > 0 THEN CAST(round(CAST(powerSum / powerCount *
    ((floor(epoch(lastSeen)) - floor(epoch(startTime))) / 3600) AS DECIMAL(30, 9)), 4) AS DOUBLE) ELSE 0.0 END AS energyConsumedSoFar,
  runningCount"""

_REPLAY = (
    _T
    + """,
replay AS (
  SELECT "offset", sessionId, chargerId, transactionId, min(eventTime) OVER w AS startTime,
    max(eventTime) OVER w AS lastSeen, sum(power) OVER w AS powerSum, count(power) OVER w AS powerCount,
    count(CASE WHEN action = 'MeterValues' THEN 1 END) OVER w AS runningCount
  FROM s WHERE NOT isStop
  WINDOW w AS (PARTITION BY sessionId ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""
)

_LIVE = (
    _REPLAY
    + """,
live AS (
  SELECT 'ocpp.active.raw' AS topic, sessionId AS key, "offset", FALSE AS gone FROM s WHERE NOT isStop
  UNION ALL SELECT 'ocpp.active', sessionId, "offset", FALSE FROM s WHERE NOT isStop
  UNION ALL SELECT t.topic, sessionId, "offset", TRUE FROM s
  CROSS JOIN (VALUES ('ocpp.active'), ('ocpp.active.raw')) AS t(topic) WHERE isStop
),
compacted AS (
  SELECT topic, key, max("offset") AS "offset", arg_max(gone, "offset") AS gone FROM live GROUP BY topic, key
)"""
)

_CURRENT = (
    _T
    + """,
current AS (
  SELECT sessionId, chargerId, transactionId, min(eventTime) AS startTime, max(eventTime) AS lastSeen,
    sum(power) AS powerSum, count(power) AS powerCount,
    count(CASE WHEN action = 'MeterValues' THEN 1 END) AS runningCount
  FROM s GROUP BY sessionId, chargerId, transactionId HAVING NOT bool_or(isStop)
)"""
)

_TOTALS = """count(*) AS sessions, round(sum(totalEnergyConsumed), 6) AS totalEnergy,
  CAST(sum(duration) AS BIGINT) AS totalDuration, round(avg(avgPower), 6) AS avgPower, max(maxPower) AS maxPower"""

_CORRECTED = (
    _H
    + """,
odd AS (SELECT * FROM history WHERE regexp_matches(stationId, '[13579]$'))"""
)

ALL = {
    "read_log": f"""WITH {_LINES}
SELECT file, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT file, 1 + CAST(event_id % 29 = 0 AS INTEGER) + CAST(event_id % 10 <> 0 AS INTEGER)
    + CAST(event_id % 17 = 0 AS INTEGER) + CAST(event_id % 23 = 0 AS INTEGER) AS n FROM m) GROUP BY file""",
    "pairs_from_files": f"WITH {_LINES} SELECT uniqueId, chargerId, action FROM answered",
    "parse_flat": f"""WITH {_LINES}
SELECT chargerId, uniqueId FROM m UNION ALL SELECT chargerId, uniqueId FROM m WHERE event_id % 29 = 0
UNION ALL SELECT chargerId, uniqueId FROM answered UNION ALL SELECT chargerId, orphanId FROM orphans
UNION ALL SELECT chargerId, 'x' || event_id FROM m WHERE event_id % 23 = 0 AND event_id % 5 = 3""",
    "message_kinds": f"""WITH {_LINES}, kinds AS (
SELECT chargerId, 'request' AS kind FROM m UNION ALL SELECT chargerId, 'request' FROM m WHERE event_id % 29 = 0
UNION ALL SELECT chargerId, 'response' FROM answered UNION ALL SELECT chargerId, 'response' FROM orphans
UNION ALL SELECT CASE WHEN event_id % 5 <> 0 THEN chargerId END, 'reject' FROM junk)
SELECT chargerId, kind, count(*) AS n FROM kinds GROUP BY chargerId, kind""",
    "reject_reasons": f"WITH {_LINES} SELECT line, reason FROM junk",
    "pairs": f"WITH {_LINES} SELECT file, uniqueId, chargerId, action FROM answered",
    "unpaired_requests": f"WITH {_LINES} SELECT file, uniqueId, chargerId FROM m WHERE event_id % 10 = 0",
    "unpaired_responses": f"WITH {_LINES} SELECT file, orphanId AS uniqueId, chargerId FROM orphans",
    "request_has_response": f"WITH {_LINES} SELECT uniqueId, event_id % 10 <> 0 AS hasResponse FROM m",
    "pairs_across_files": f"""WITH {_LINES}
SELECT scope, status, count(*) AS n FROM (
  SELECT 'global' AS scope, CASE WHEN event_id % 10 <> 0 THEN 'pair' ELSE 'unpaired_request' END AS status FROM m
  UNION ALL SELECT 'file', 'unpaired_request' FROM m
  UNION ALL SELECT 'file', 'unpaired_response' FROM answered
  UNION ALL SELECT unnest(['global', 'file']), 'unpaired_response' FROM orphans) GROUP BY scope, status""",
    "ingest_counts": f"""WITH {_LINES}
SELECT status, reason, count(*) AS n FROM (
  SELECT CASE WHEN event_id % 10 <> 0 THEN 'pair' ELSE 'unpaired_request' END AS status,
    CASE WHEN event_id % 10 = 0 THEN 'unpaired_request_no_response' END AS reason FROM m
  UNION ALL SELECT 'unpaired_response', 'unpaired_response_no_request' FROM orphans
  UNION ALL SELECT 'reject', reason FROM junk) GROUP BY status, reason""",
    "message_log": f"WITH {_LINES} SELECT 'ocpp.messages' AS topic, uniqueId AS key, chargerId FROM answered",
    "recovered_transactions": f"""WITH {_LINES}
SELECT uniqueId AS key, 'R' || event_id AS transactionId FROM answered WHERE action = 'StartTransaction'""",
    "dead_letter": f"""WITH {_LINES}
SELECT 'ocpp.malformed' AS topic, chargerId, uniqueId, CAST(NULL AS VARCHAR) AS line,
  'unpaired_request_no_response' AS reason FROM m WHERE event_id % 10 = 0
UNION ALL SELECT 'ocpp.malformed', chargerId, orphanId, NULL, 'unpaired_response_no_request' FROM orphans
UNION ALL SELECT 'ocpp.malformed', NULL, NULL, line, reason FROM junk""",
    "last_per_key": """SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
  arg_max(value, event_id) AS value FROM events GROUP BY user_id""",
    "decode_envelope": f'WITH {_T} SELECT topic, "offset", uniqueId, chargerId FROM typed',
    "decode_typed": f"WITH {_T} SELECT * FROM typed",
    "decode_strict_millis": f"""WITH {_M}
SELECT action, count(*) AS n, count(CASE WHEN event_id % 4 = 0 AND action <> 'Heartbeat' THEN 1 END) AS timed
FROM m GROUP BY action""",
    "decode_literals": f"""WITH {_M}
SELECT event_id AS "offset", uniqueId, action, 'it''s ' || user_id AS idTag,
  CAST(1 + user_id % 2 AS INTEGER) AS connectorId FROM m""",
    "session_messages": f'WITH {_T} SELECT "offset", sessionId, action, isStop FROM s',
    "active_and_stop_messages": f"""WITH {_T}
SELECT CASE WHEN isStop THEN 'stop' ELSE 'active' END AS branch, sessionId, "offset" FROM s""",
    "meter_samples": f"""WITH {_SAMPLES}
SELECT "offset", transactionId, entry, "position", sampleTime, measurand, unit, value,
  'Sample.Periodic' AS context, 'Raw' AS format, 'Outlet' AS location FROM samples""",
    "sample_pivot": f"""WITH {_SAMPLES}
SELECT "offset", transactionId,
  CASE WHEN "offset" % 11 = 0 THEN NULL ELSE max(CASE WHEN entry = 0 AND measurand = 'Power.Active.Import' THEN value
    END) END AS power,
  max(CASE WHEN measurand = 'Voltage' THEN value END) AS Voltage, max(CASE WHEN measurand = 'SoC' THEN value END) AS SoC
FROM samples GROUP BY "offset", transactionId""",
    "status_rows": f"""WITH {_M}
SELECT chargerId, CAST(1 + user_id % 2 AS INTEGER) AS connectorId,
  CASE WHEN event_id % 3 = 0 THEN 'Faulted' ELSE 'Available' END AS status,
  CASE WHEN event_id % 3 = 0 THEN 'InternalError' ELSE 'NoError' END AS errorCode,
  CASE WHEN event_id % 3 = 0 THEN '012230' ELSE '' END AS vendorErrorCode, ts AS eventTime, event_id AS "offset"
FROM m WHERE action = 'StatusNotification'""",
    "normalized_raw": f"""WITH {_T}
SELECT 'ocpp.active.raw' AS topic, sessionId AS key, "offset", chargerId AS stationId, timestamp_str AS "timestamp",
  action, CASE WHEN action = 'StartTransaction' THEN transactionId END AS transactionId, meterStart, idTag,
  CASE WHEN action = 'StartTransaction' THEN connectorId END AS connectorId, power, soc, voltage
FROM s WHERE NOT isStop""",
    "session_aggregate": f"""WITH {_H}
SELECT chargerId, transactionId, sessionId, startTime, endTime, eventCount, terminationReason,
  round(powerSum, 6) AS powerSum, powerCount, meterStart, meterStop, idTag, connectorId, socStart, socEnd,
  round(socAvg, 6) AS socAvg, maxPower, round(voltageAvg, 6) AS voltageAvg, voltageMin, voltageMax FROM agg""",
    "completed_sessions": f"WITH {_H} SELECT {_HISTORY_COLUMNS} FROM history",
    "completed_stop_only": f"""WITH {_T}, {_sessions("'StopTransaction'")}
SELECT sessionId, endTime, duration, socFirst AS socStart, socLast AS socEnd FROM done""",
    "completed_by_epoch": f"""WITH {_T}, e AS (
  SELECT *, coalesce(sum(CAST(isStop AS INTEGER)) OVER (PARTITION BY sessionId ORDER BY "offset"
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS epoch FROM s)
SELECT sessionId || '_' || epoch AS sessionId, min(eventTime) AS startTime, max(eventTime) AS endTime,
  CAST(floor(epoch(max(eventTime))) - floor(epoch(min(eventTime))) AS INTEGER) AS duration, count(*) AS eventCount
FROM e GROUP BY e.sessionId, epoch HAVING bool_or(isStop)""",
    "session_epochs": f"""WITH {_T}
SELECT "offset", sessionId, CAST(coalesce(sum(CAST(isStop AS INTEGER)) OVER (PARTITION BY sessionId ORDER BY "offset"
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS epoch FROM s""",
    "first_event_time": f"""WITH {_T}, f AS (
  SELECT "offset", chargerId, min(eventTime) OVER (PARTITION BY sessionId) AS sessionStart FROM s)
SELECT "offset", sessionStart, chargerId || '_' || strftime(sessionStart, '%Y-%m-%dT%H:%M:%S') ||
  CASE WHEN epoch_us(sessionStart) % 1000000 = 0 THEN '' ELSE strftime(sessionStart, '.%f') END || '+00:00'
  AS startSessionId FROM f""",
    "running_state": f"WITH {_CURRENT} SELECT {_STATE} FROM current",
    "running_state_replay": f'WITH {_REPLAY} SELECT "offset", {_STATE} FROM replay',
    "running_state_by_time": f'WITH {_REPLAY} SELECT "offset", {_STATE} FROM replay',
    "distinct_sessions": f"WITH {_T} SELECT DISTINCT sessionId FROM s",
    "track_sessions": f"""WITH {_M}, {_tracked("chargerId, transactionId", "any_value(chargerId)")}
SELECT * EXCLUDE (closed) FROM tracked_rows WHERE closed""",
    "track_sessions_open": f"""WITH {_M}, {_tracked("transactionId",
        "coalesce(arg_max(chargerId, event_id) FILTER (WHERE action = 'StopTransaction'), arg_min(chargerId, event_id))")}
SELECT * EXCLUDE (closed) FROM tracked_rows WHERE closed OR startTime IS NOT NULL""",
    "session_status": f"""WITH {_T}, g AS (
  SELECT sessionId, any_value(chargerId) AS stationId, count(CASE WHEN action = 'MeterValues' THEN 1 END) AS readings,
    coalesce(min(CASE WHEN action = 'MeterValues' THEN eventTime END), min(eventTime)) AS startTime,
    max(CASE WHEN isStop THEN eventTime END) AS endTime, max(eventTime) AS latest, max(reason) AS reason,
    avg(power) AS avgPower, count(*) AS eventCount FROM s GROUP BY sessionId),
c AS (SELECT *, CASE WHEN readings > 0 THEN CASE WHEN endTime IS NOT NULL THEN 'ended' ELSE 'active' END END AS status,
  coalesce(endTime, latest) AS lastSeen FROM g),
d AS (SELECT *, CAST(floor(epoch(lastSeen)) - floor(epoch(startTime)) AS INTEGER) AS duration FROM c)
SELECT sessionId, stationId, status, CASE WHEN status = 'ended' THEN reason END AS terminationReason, startTime,
  endTime, lastSeen, duration, CAST(round(CAST(avgPower * (duration / 3600.0) AS DECIMAL(30, 9)), 3) AS DOUBLE) AS totalEnergyConsumed, eventCount FROM d""",
    "trapezoid_energy": f"""WITH {_T}, p AS (
  SELECT sessionId, power, epoch_us(eventTime) AS t, lag(power) OVER w AS p0, lag(epoch_us(eventTime)) OVER w AS t0
  FROM s WHERE power IS NOT NULL WINDOW w AS (PARTITION BY sessionId ORDER BY eventTime, "offset"))
SELECT sessionId, CAST(round(CAST(coalesce(sum((power + p0) / 2 * (t - t0) / 3.6e9), 0.0) AS DECIMAL(30, 9)), 3) AS DOUBLE) AS energy, count(*) AS readings
FROM p GROUP BY sessionId""",
    "active_overview": f"""WITH {_LIVE}
SELECT {_STATE} FROM replay JOIN compacted c ON c.key = replay.sessionId AND c."offset" = replay."offset"
WHERE c.topic = 'ocpp.active' AND NOT c.gone""",
    "compacted_view": f'WITH {_LIVE} SELECT topic, key, "offset" FROM compacted WHERE NOT gone',
    "raw_after_tombstone": f"""WITH {_LIVE}, l AS (
  SELECT *, max(CASE WHEN gone THEN "offset" END) OVER (PARTITION BY topic, key) AS cut FROM live)
SELECT topic, key, "offset" FROM l WHERE NOT gone AND (cut IS NULL OR "offset" > cut)""",
    "tombstones": f"""WITH {_T}
SELECT t.topic, sessionId AS key, CAST(NULL AS VARCHAR) AS value, max("offset") AS "offset" FROM s
CROSS JOIN (VALUES ('ocpp.active'), ('ocpp.active.raw')) AS t(topic) WHERE isStop GROUP BY t.topic, sessionId""",
    "retention": f"""WITH {_T}
SELECT "offset", sessionId, eventTime FROM s WHERE eventTime >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 3 DAY""",
    "live_log_of_charger": f"""WITH {_T}
SELECT sessionId AS key, "offset" FROM s WHERE NOT isStop AND chargerId = 'charger6'
  AND eventTime < TIMESTAMP '2024-01-24 00:00:00'""",
    "energy_by_station": f"""WITH {_H}
SELECT stationId, count(*) AS sessions, round(sum(totalEnergyConsumed), 6) AS totalEnergy FROM history
WHERE startTime >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 14 DAY GROUP BY stationId""",
    "termination_stats": f"""WITH {_H}
SELECT terminationReason, count(*) AS sessions, round(avg(totalEnergyConsumed), 6) AS avgEnergy FROM history
GROUP BY terminationReason""",
    "station_sessions": f"""WITH {_H} SELECT {_HISTORY_COLUMNS} FROM history
WHERE stationId = 'charger6' AND startTime >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY""",
    "sessions_by_day_station": f"""WITH {_H}
SELECT CAST(date_trunc('day', startTime) AS TIMESTAMP) AS period, stationId, {_TOTALS} FROM history GROUP BY 1, 2""",
    "sessions_by_week": f"""WITH {_H}
SELECT CAST(date_trunc('week', startTime) AS TIMESTAMP) AS period, {_TOTALS} FROM history GROUP BY 1""",
    "station_health": f"""WITH {_M}
SELECT chargerId, CAST(1 + user_id % 2 AS INTEGER) AS connectorId,
  arg_max(CASE WHEN event_id % 3 = 0 THEN 'Faulted' ELSE 'Available' END, event_id) AS status,
  arg_max(CASE WHEN event_id % 3 = 0 THEN 'InternalError' ELSE 'NoError' END, event_id) AS errorCode,
  arg_max(CASE WHEN event_id % 3 = 0 THEN '012230' ELSE '' END, event_id) AS vendorErrorCode,
  max(ts) AS lastReport, count(*) AS reports, count(CASE WHEN event_id % 3 = 0 THEN 1 END) AS errors
FROM m WHERE action = 'StatusNotification' GROUP BY 1, 2""",
    "last_heartbeat": f"""WITH {_LINES}
SELECT chargerId, max(ts) AS lastHeartbeat FROM answered WHERE action = 'Heartbeat' GROUP BY chargerId""",
    "all_chargers": f"WITH {_M} SELECT DISTINCT chargerId FROM m",
    "all_actions": f"WITH {_M} SELECT DISTINCT action FROM m",
    "charger_payloads": f"""WITH {_M}
SELECT uniqueId, action, CASE WHEN action NOT IN ('Heartbeat', 'StatusNotification') THEN txn END AS transactionId
FROM m WHERE chargerId = 'charger6'""",
    "lookup": f"""WITH {_H} SELECT {_HISTORY_COLUMNS} FROM history
WHERE stationId = 'charger6' AND terminationReason = 'HardReset'""",
    "newest_sessions": f"WITH {_H} SELECT {_HISTORY_COLUMNS} FROM history ORDER BY startTime DESC, sessionId LIMIT 10",
    "active_history_bridge": f"""WITH {_H}, current AS (
  SELECT sessionId, chargerId, transactionId, min(eventTime) AS startTime, max(eventTime) AS lastSeen,
    sum(power) AS powerSum, count(power) AS powerCount,
    count(CASE WHEN action = 'MeterValues' THEN 1 END) AS runningCount
  FROM s GROUP BY sessionId, chargerId, transactionId HAVING NOT bool_or(isStop)),
state AS (SELECT {_STATE} FROM current)
SELECT sessionId, stationId, transactionId, status, startTime, lastSeen, duration, totalEnergyConsumed, eventCount
FROM history
UNION ALL SELECT sessionId, stationId, transactionId, status, startTime, lastSeen, duration, energyConsumedSoFar,
  runningCount FROM state""",
    "history_upsert": f"""WITH {_CORRECTED}
SELECT sessionId, CASE WHEN regexp_matches(stationId, '[13579]$') THEN 'corrected' ELSE terminationReason END
  AS terminationReason, eventCount FROM history
UNION ALL SELECT sessionId || '_new', 'corrected', eventCount FROM odd""",
    "history_upsert_skip": f"""WITH {_CORRECTED}
SELECT sessionId, terminationReason FROM history UNION ALL SELECT sessionId || '_new', 'corrected' FROM odd""",
    "history_update": f"""WITH {_H}
SELECT sessionId, CASE WHEN terminationReason = 'HardReset' THEN 'Reset' ELSE terminationReason END
  AS terminationReason, CASE WHEN terminationReason = 'HardReset' THEN eventCount + 1 ELSE eventCount END AS eventCount
FROM history""",
    "history_delete": f"""WITH {_H}
SELECT sessionId, terminationReason FROM history
WHERE NOT regexp_matches(stationId, '[13579]$') AND terminationReason IS DISTINCT FROM 'SoftReset'""",
    "history_defaults": f"""WITH {_H}
SELECT sessionId, duration, CAST(NULL AS VARCHAR) AS terminationReason, CAST(NULL AS BIGINT) AS meterStart,
  CAST(0 AS BIGINT) AS eventCount FROM history""",
    "history_written": f"""WITH {_CORRECTED}
SELECT sessionId, CASE WHEN regexp_matches(stationId, '[13579]$') THEN 'corrected' ELSE terminationReason END
  AS terminationReason, startTime, eventCount FROM history
UNION ALL SELECT sessionId || '_new', 'corrected', startTime, eventCount FROM odd""",
    "history_exported": f"""WITH {_H}
SELECT sessionId, status, duration, totalEnergyConsumed AS value, 'kWh' AS unit FROM history""",
    "charger_session_table": f"""WITH {_M}, {_tracked("chargerId, transactionId", "any_value(chargerId)")}
SELECT sessionId, stationId, status, terminationReason, startTime, endTime, duration, totalEnergyConsumed, eventCount
FROM tracked_rows WHERE closed""",
    "dq_required": f"""WITH {_H}
SELECT CAST(0 AS BIGINT) AS sessionId, CAST(0 AS BIGINT) AS stationId, CAST(0 AS BIGINT) AS transactionId,
  CAST(0 AS BIGINT) AS startTime, count(CASE WHEN duration % 7 = 0 THEN 1 END) AS endTime, CAST(0 AS BIGINT) AS duration
FROM history""",
    "dq_meter": f"WITH {_H} SELECT sessionId, meterStart, meterStop FROM history WHERE meterStop < meterStart",
    "dq_energy": f"""WITH {_H}
SELECT sessionId FROM history WHERE duration % 5 = 0 AND totalEnergyConsumed IS NOT NULL""",
    "dq_duration": f"WITH {_H} SELECT sessionId, duration + 2 AS duration FROM history WHERE duration % 5 = 0",
    "dq_exclusive": f"WITH {_H} SELECT sessionId FROM history WHERE duration % 3 = 0",
    "dq_status": f"WITH {_H} SELECT sessionId, 'active' AS status FROM history WHERE duration % 5 = 0",
    "stream_history": f"WITH {_H} SELECT {_HISTORY_COLUMNS} FROM history",
    "stream_active": f"WITH {_CURRENT} SELECT {_STATE} FROM current",
    "stream_lifecycle": f"""WITH {_T}, b AS (
  SELECT *, CAST(floor((day(eventTime) - 1) / 8) AS INTEGER) AS part FROM s),
c AS (SELECT *, min(CASE WHEN isStop THEN part END) OVER (PARTITION BY sessionId) AS stopPart FROM b)
SELECT sessionId, min(CASE WHEN part <= stopPart THEN eventTime END) AS startTime,
  max(CASE WHEN part <= stopPart AND isStop THEN eventTime END) AS endTime,
  count(CASE WHEN part <= stopPart THEN 1 END) AS eventCount, count(CASE WHEN part > stopPart THEN 1 END) AS late
FROM c WHERE stopPart IS NOT NULL GROUP BY sessionId""",
    "stream_pairs": f"WITH {_LINES} SELECT uniqueId, chargerId FROM answered",
}
ALL |= {
    "stream_dead_letters": ALL["dead_letter"],
    "completed_from_mixed": ALL["completed_sessions"],
    "status_from_mixed": ALL["status_rows"],
    "number_kinds": f"""WITH {_M}
SELECT event_id AS "offset", CASE WHEN event_id % 2 = 1 THEN event_id END AS meterStart FROM m
WHERE action = 'StartTransaction'""",
    "epochs_of_partitions": ALL["session_epochs"],
    "recovered_in_quotes": ALL["recovered_transactions"],
    "history_upsert_repeated": ALL["history_upsert"],
    "history_by_day": ALL["energy_by_station"],
    "history_plain": ALL["completed_sessions"],
    "retention_purged": f"""WITH {_T}
SELECT "offset", sessionId, eventTime, strftime(eventTime, '%Y-%m-%d') AS day FROM s
WHERE eventTime >= TIMESTAMP '2024-01-28 09:00:00'""",
    "stream_log_pairs": ALL["pairs_from_files"],
    "stream_log_accounted": f"""WITH {_LINES},
calls AS (
  SELECT file, event_id, event_id % 29 = 0 AS twice, event_id % 10 <> 0 AS answered, event_id % 17 = 0 AS orphan FROM m),
counted AS (
  SELECT 'pair' AS status, 1 + CAST(twice AS INTEGER) AS n, 2 + CAST(twice AS INTEGER) AS lines FROM calls
  WHERE answered AND file <> '20240105'
  UNION ALL SELECT 'unpaired_request', 1 + CAST(twice AS INTEGER), 1 + CAST(twice AS INTEGER) FROM calls
  WHERE NOT answered AND file <> '20240105'
  UNION ALL SELECT 'unpaired_response', 1, 1 FROM calls WHERE orphan AND file <> '20240105'
  UNION ALL SELECT 'late', x, x FROM (SELECT 1 + CAST(twice AS INTEGER) + CAST(answered AS INTEGER) + CAST(orphan AS INTEGER) AS x
    FROM calls WHERE file = '20240105')
  UNION ALL SELECT 'reject', 1, 1 FROM junk)
SELECT status, CAST(sum(n) AS BIGINT) AS n, CAST(sum(lines) AS BIGINT) AS lines FROM counted GROUP BY status""",
    "compacted_incremental": ALL["compacted_view"],
    "dead_letter_quoted": f"""WITH {_LINES}
SELECT chargerId, '"' || uniqueId || '"' AS uniqueId, 'unpaired_request_no_response' AS reason FROM m WHERE event_id % 10 = 0
UNION ALL SELECT chargerId, '"' || orphanId || '"', 'unpaired_response_no_request' FROM orphans""",
    "sessions_by_each": f"""WITH {_H}, g AS (
SELECT *, CAST(date_trunc('day', startTime) AS TIMESTAMP) AS d, CAST(date_trunc('week', startTime) AS TIMESTAMP) AS w FROM history)
SELECT CASE WHEN grouping(d) = 0 THEN 'day' WHEN grouping(w) = 0 THEN 'week' END AS grain, coalesce(d, w) AS period, stationId,
  CAST(1 - grouping(stationId) AS INTEGER) AS level, {_TOTALS}
FROM g GROUP BY GROUPING SETS ((d, stationId), (d), (w, stationId), (w), (stationId), ())""",
    "history_versions": ALL["history_upsert"],
    "charger_sessions_kept": ALL["charger_session_table"] + """
QUALIFY row_number() OVER (PARTITION BY sessionId ORDER BY stationId DESC NULLS LAST, status DESC NULLS LAST,
  terminationReason DESC NULLS LAST, startTime DESC NULLS LAST, endTime DESC NULLS LAST, duration DESC NULLS LAST,
  totalEnergyConsumed DESC NULLS LAST, eventCount DESC NULLS LAST) = 1""",
    "stream_history_once": ALL["stream_history"],
    "stream_lifecycle_batches": ALL["stream_lifecycle"],
}
