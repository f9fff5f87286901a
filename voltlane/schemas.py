"""Column contracts of the tables and topics, as Spark DDL."""

# Topic names.
MESSAGES_TOPIC = "ocpp.messages"
MALFORMED_TOPIC = "ocpp.malformed"
ACTIVE_TOPIC = "ocpp.active"
ACTIVE_RAW_TOPIC = "ocpp.active.raw"

# OCPP actions.
START = "StartTransaction"
METER = "MeterValues"
STOP = "StopTransaction"
REMOTE_STOP = "RemoteStopTransaction"
STATUS = "StatusNotification"
HEARTBEAT = "Heartbeat"
SESSION_ACTIONS = [METER, STOP, START, REMOTE_STOP]
STOP_ACTIONS = [STOP, REMOTE_STOP]

# Measurands.
POWER = "Power.Active.Import"
VOLTAGE = "Voltage"
SOC_MEASURANDS = ["Battery.SOC", "SoC"]
MEASURANDS = [
    "Current.Import",
    "Energy.Active.Import.Register",
    "Energy.Active.Import.Interval",
    "Power.Active.Import",
    "Voltage",
    "SoC",
    "Current.Offered",
    "Power.Offered",
]

# Dead-letter reasons.
UNPAIRED_REQUEST = "unpaired_request_no_response"
UNPAIRED_RESPONSE = "unpaired_response_no_request"
NO_MATCH = "regex match failed"
NOT_PARSED = "JSON/ast parsing failed"
TOO_SHORT = "message too short"
NOT_ARRAY = "not an array"
UNKNOWN_TYPE = "unknown message type: "

# The transactionId of the envelope is only set when a response supplied it.
ENVELOPE = "chargerId STRING, uniqueId STRING, message STRING, transactionId STRING"

SAMPLE = "value: STRING, measurand: STRING, unit: STRING"
FULL_SAMPLE = "value: STRING, context: STRING, format: STRING, measurand: STRING, location: STRING, unit: STRING"

# Scalars are read as text and cast afterwards, so a badly typed field is null and spoils no other field. Whole numbers
# are read as variants first, which tell a JSON number from a string.
NUMBERS = ["meterStart", "meterStop", "connectorId"]
_PAYLOAD = (
    "transactionId STRING, timestamp STRING, meterStart VARIANT, meterStop VARIANT, idTag STRING, "
    "connectorId VARIANT, reason STRING, status STRING, errorCode STRING, vendorErrorCode STRING, "
    "currentTime STRING, meterValue ARRAY<STRUCT<timestamp: STRING, sampledValue: ARRAY<STRUCT<{}>>>>"
)
PAYLOAD = _PAYLOAD.format(SAMPLE)
FULL_PAYLOAD = _PAYLOAD.format(FULL_SAMPLE)
STATUS_PAYLOAD = "connectorId VARIANT, status STRING, errorCode STRING, vendorErrorCode STRING, timestamp STRING"

# More partitions than a topic has.
PARTITIONS = 4096

MESSAGE_LOG = "topic STRING, key STRING, value STRING, offset BIGINT, timestamp TIMESTAMP"
PARTITIONED_LOG = MESSAGE_LOG + ", partition INT"

HISTORY = (
    "sessionId STRING, stationId STRING, transactionId STRING, status STRING, startTime TIMESTAMP, "
    "endTime TIMESTAMP, duration INT, lastSeen TIMESTAMP, terminationReason STRING, "
    "totalEnergyConsumed DOUBLE, avgPower DOUBLE, maxPower DOUBLE, idTag STRING, connectorId INT, "
    "meterStart BIGINT, meterStop BIGINT, socStart DOUBLE, socEnd DOUBLE, voltageAvg DOUBLE, eventCount BIGINT"
)

CHARGER_SESSION = (
    "sessionId STRING, stationId STRING, status STRING, terminationReason STRING, startTime TIMESTAMP, "
    "endTime TIMESTAMP, duration INT, totalEnergyConsumed DOUBLE, eventCount BIGINT"
)

ACTIVE_STATE = (
    "sessionId STRING, stationId STRING, transactionId STRING, status STRING, startTime STRING, "
    "lastSeen STRING, duration INT, energyConsumedSoFar DOUBLE, runningCount BIGINT"
)

ACTIVE_RAW = (
    "stationId STRING, timestamp STRING, action STRING, value STRUCT<transactionId: STRING, meterStart: BIGINT, "
    "idTag: STRING, connectorId: INT, power: DOUBLE, soc: DOUBLE, voltage: DOUBLE>"
)


def columns(ddl: str) -> list[str]:
    """Field names of a flat contract, in order."""
    return [field.split()[0] for field in ddl.split(",")]
