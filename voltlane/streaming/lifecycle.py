"""Session lifecycle with bounded state: fold messages, close at the stop, forget after a while."""

import json
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.operators.topics import live_value

SESSION = (
    "startTime TIMESTAMP, endTime TIMESTAMP, latest TIMESTAMP, eventCount BIGINT, runningCount BIGINT, "
    "powerSum DOUBLE, powerCount BIGINT, maxPower DOUBLE, socStart DOUBLE, socEnd DOUBLE, voltageSum DOUBLE, "
    "voltageCount BIGINT, meterStart BIGINT, meterStop BIGINT, connectorId INT, idTag STRING, "
    "terminationReason STRING, voltageAvg DOUBLE, lastOffset BIGINT"
)
INPUT = ["sessionId", "offset", "chargerId", "transactionId", "action", "eventTime", "power", "soc", "voltage",
         "meterStart", "meterStop", "idTag", "connectorId", "reason", "isStop"]
# Messages pass as the text that goes to the live log and sessions as JSON: flat rows of text are what Arrow moves
# cheaply when a session has only a few messages in a batch.
OUTPUT = "kind STRING, sessionId STRING, chargerId STRING, transactionId STRING, offset BIGINT, value STRING"
STATE = f"chargerId STRING, transactionId STRING, closed BOOLEAN, {SESSION}"

_FIELDS = S.columns(STATE)
_SESSION_FIELDS = S.columns(SESSION)
# How the summaries of two sets of messages merge.
_LEAST = ("startTime", "socStart")
_SUMS = ("eventCount", "runningCount", "powerSum", "powerCount", "voltageSum", "voltageCount")


def _known(values) -> list:
    """The values that are there; NaN counts as none."""
    return [v for v in values if v is not None and v == v]


def _most(values, kind=float):
    return kind(max(values)) if values else None


def _summary(columns: dict[str, tuple]) -> dict:
    """Aggregates of a chunk of one session's messages, given as columns. Most sessions have a few messages in a batch, for
    which plain Python takes a small part of the time that pandas takes."""
    action, times = columns["action"], columns["eventTime"]
    power, voltage, soc = (_known(columns[c]) for c in ("power", "voltage", "soc"))
    of = lambda kind, c: _known(v for v, a in zip(columns[c], action) if a == kind)
    stops = [t for t, is_stop in zip(times, columns["isStop"]) if is_stop]
    return {
        "startTime": min(times),
        "endTime": max(stops) if stops else None,
        "latest": max(times),
        "eventCount": len(times),
        "runningCount": action.count(S.METER),
        "powerSum": float(sum(power)),
        "powerCount": len(power),
        "maxPower": _most(power),
        "socStart": float(min(soc)) if soc else None,
        "socEnd": _most(soc),
        "voltageSum": float(sum(voltage)),
        "voltageCount": len(voltage),
        "meterStart": _most(of(S.START, "meterStart"), int),
        "meterStop": _most(of(S.STOP, "meterStop"), int),
        "connectorId": _most(of(S.START, "connectorId"), int),
        "idTag": _most(of(S.START, "idTag"), str),
        "terminationReason": _most(of(S.STOP, "reason"), str),
        "lastOffset": int(max(columns["offset"])),
    }


def _merge(name, a, b):
    if a is None or b is None:
        return b if a is None else a
    if name in _SUMS:
        return a + b
    return min(a, b) if name in _LEAST else max(a, b)


def _session(kind, key, state):
    text = json.dumps({c: state[c] for c in _SESSION_FIELDS}, default=datetime.isoformat)
    return [(kind, key[0], state["chargerId"], state["transactionId"], state["lastOffset"], text)]


def _messages(kind, key, columns, stops=True):
    rows = zip(*(columns[c] for c in ("isStop", "chargerId", "transactionId", "offset", "value")))
    return [(kind, key[0], *values) for is_stop, *values in rows if stops or not is_stop]


def _columns(chunk):
    messages = [json.loads(m) for m in chunk["message"]]
    columns = {c: tuple(m.get(c) for m in messages) for c in (*INPUT, "value")}
    for c in ("power", "soc", "voltage"):
        columns[c] = tuple(None if v is None else float(v) for v in columns[c])
    return columns | {"eventTime": tuple(map(datetime.fromisoformat, columns["eventTime"]))}


def _frame(rows):
    return pd.DataFrame(rows, columns=S.columns(OUTPUT), dtype=object)


class SessionLifecycle:
    """Emits each message as ``raw``, the session as ``state`` or, at its stop, ``closed``; after that ``late``.

    A micro-batch counts as one set: messages that arrive together with the stop still belong to the session.
    Rows are folded chunk by chunk, so a crowded session is never held whole."""

    def __init__(self, closed_ms: int | None, idle_ms: int | None):
        self.closed_ms, self.idle_ms = closed_ms, idle_ms

    def __call__(self, key, rows, held):
        if held.hasTimedOut:
            state = dict(zip(_FIELDS, held.get))
            held.remove()
            if not state["closed"]:
                yield _frame(_session("expired", key, state))
            return
        state = dict(zip(_FIELDS, held.get)) if held.exists else dict.fromkeys(_FIELDS)
        if state["closed"]:
            for chunk in rows:
                yield _frame(_messages("late", key, _columns(chunk)))
            # A call without a timer would unset it; what is late doesn't put it off.
            if self.closed_ms is not None:
                held.setTimeoutDuration(max(1, held.oldTimeoutTimestamp - held.getCurrentProcessingTimeMs()))
            return
        waiting = []
        for chunk in rows:
            if waiting:
                yield _frame(waiting)
            columns = _columns(chunk)
            waiting = _messages("raw", key, columns, stops=False)
            state["chargerId"], state["transactionId"] = columns["chargerId"][0], columns["transactionId"][0]
            for name, value in _summary(columns).items():
                state[name] = _merge(name, state[name], value)
        if state["voltageCount"]:
            state["voltageAvg"] = state["voltageSum"] / state["voltageCount"]
        state["closed"] = state["endTime"] is not None
        held.update(tuple(state[c] for c in _FIELDS))
        wait = self.closed_ms if state["closed"] else self.idle_ms
        if wait is not None:
            held.setTimeoutDuration(max(1, wait))
        yield _frame(waiting + _session("closed" if state["closed"] else "state", key, state))


def session_lifecycle(messages: DataFrame, closed_ms: int | None = None, idle_ms: int | None = None) -> DataFrame:
    """Stateful stream of tagged rows.

    ``closed_ms`` is how long a closed session turns late messages away before its state is dropped; ``idle_ms``
    drops sessions that never stop. Timers run on processing time, as an event-time watermark would drop the
    messages of a charger that reports late. With a timer set the query has something to do for ever, so a bounded
    run (``availableNow``) sets none and keeps the state."""
    # One column of text: a session has a few messages in a batch, and each column of its rows is converted by itself.
    time = F.date_format("eventTime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("eventTime")
    fields = [time if c == "eventTime" else F.col(c) for c in INPUT if c != "sessionId"]
    rows = messages.select("sessionId", F.to_json(F.struct(*fields, live_value().alias("value"))).alias("message"))
    return rows.groupBy("sessionId").applyInPandasWithState(
        SessionLifecycle(closed_ms, idle_ms).__call__,
        OUTPUT,
        STATE,
        "append",
        "NoTimeout" if closed_ms is None and idle_ms is None else "ProcessingTimeTimeout",
    )
