"""Small inputs for the tests."""

import json

from voltlane import schemas as S


def call(action, uid="u1", **payload):
    return json.dumps([2, uid, action, payload])


def reading(at, **values):
    """MeterValues entry: power, soc, voltage by keyword."""
    names = {"power": "Power.Active.Import", "soc": "Battery.SOC", "voltage": "Voltage"}
    samples = [{"value": str(v), "measurand": names[n], "unit": "x"} for n, v in values.items()]
    return {"timestamp": at, "sampledValue": samples}


def records(spark, calls, charger="charger1"):
    """Message topic with one record per call, offsets in order; items are texts or (charger, text)."""
    rows = []
    for offset, item in enumerate(calls):
        who, text = item if isinstance(item, tuple) else (charger, item)
        envelope = json.dumps({"chargerId": who, "uniqueId": f"u{offset}", "message": text})
        rows.append((S.MESSAGES_TOPIC, f"u{offset}", envelope, offset, None))
    return spark.createDataFrame(rows, S.MESSAGE_LOG)


def full_session(charger="pole-k", txn="t77"):
    """Twenty minutes: a start, three readings four minutes apart, a stop."""
    return [
        (charger, call("StartTransaction", transactionId=txn, meterStart=41200, idTag="card-amber", connectorId=2,
                       timestamp="2025-03-04T08:15:00.000Z")),
        *[
            (charger, call("MeterValues", transactionId=txn, meterValue=[
                reading(f"2025-03-04T08:{15 + 4 * i}:00.000Z", power=7.5 * i, soc=40 + 3 * i, voltage=231 + i)]))
            for i in (1, 2, 3)
        ],
        (charger, call("StopTransaction", transactionId=txn, meterStop=41950, reason="Local",
                       timestamp="2025-03-04T08:35:00.000Z")),
    ]
