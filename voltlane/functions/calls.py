"""Column expressions over OCPP calls: ``[2, uniqueId, action, payload]`` and ``[3, uniqueId, payload]``."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlane import schemas as S


def evaluate_once(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add columns through a generator. Catalyst does not push later filters through it, so a costly expression
    (a JSON parse) runs once per row instead of once in the filter and again in the projection."""
    return df.select("*", F.inline(F.array(F.struct(*[e.alias(n) for n, e in exprs.items()]))))


def call_elements(text: Column) -> Column:
    """The call array as ARRAY<STRING>; nested values stay JSON text. Null when the text is no array."""
    return F.from_json(text, "array<string>")


def strict_call_elements(body: Column) -> Column:
    """Like call_elements, but null when anything follows the closing bracket."""
    return F.from_json(F.concat(F.lit('{"m":'), body, F.lit("}")), "m array<string>")["m"]


def payload_struct(payload: Column, contract: str = S.PAYLOAD) -> Column:
    return F.from_json(payload, contract)


def utc_text(ts: Column) -> Column:
    return F.replace(ts, F.lit("Z"), F.lit("+00:00"))


def event_time(ts: Column, strict_millis: bool = False) -> Column:
    """ISO-8601 date and time to timestamp, null when the text is none. ``strict_millis`` accepts three-digit
    fractions only."""
    complete = (F.substring(ts, 11, 1) == "T") & (F.length(ts) >= 19)
    if strict_millis:
        complete = ts.rlike(r"T\d{2}:\d{2}:\d{2}\.\d{3}([+-]\d{2}(:?\d{2})?|Z)$")
    return F.when(complete, ts.try_cast("timestamp"))


def iso_text(ts: Column) -> Column:
    """ISO-8601 with offset; the fraction is left out when it is zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX")
    fraction = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    utc = F.when(ts == F.date_trunc("second", ts), whole).otherwise(fraction)
    return utc_text(utc)


def nested_timestamp(meter_value: Column) -> Column:
    return F.get(meter_value, F.lit(0))["timestamp"]


def timestamp_text(action: Column, top: Column, meter_value: Column) -> Column:
    nested = F.when(action == S.METER, F.nullif(nested_timestamp(meter_value), F.lit("")))
    return utc_text(F.coalesce(F.nullif(top, F.lit("")), nested))


def samples_of(meter_value: Column) -> Column:
    """All sampled values of a message as one array, in message order."""
    usable = F.filter(meter_value, lambda m: m["sampledValue"].isNotNull())
    return F.flatten(F.transform(usable, lambda m: m["sampledValue"]))


def timed_values(meter_value: Column) -> Column:
    """The meterValue entries that carry a timestamp."""
    return F.filter(meter_value, lambda m: m["timestamp"] != F.lit(""))


def number_of(sample: Column, normalize_units: bool = False) -> Column:
    value = sample["value"].try_cast("double")
    if not normalize_units:
        return value
    return F.when(sample["unit"].isin("W", "Wh"), value / 1000).otherwise(value)


def power_values(samples: Column, normalize_units: bool = False) -> Column:
    """Every Power.Active.Import sample that converts to a number."""
    power = F.filter(samples, lambda s: s["measurand"] == S.POWER)
    return F.filter(F.transform(power, lambda s: number_of(s, normalize_units)), lambda v: v.isNotNull())


def first_sample(samples: Column, measurands: list[str]) -> Column:
    """The first sample with one of the measurands, as a number; null if that one does not convert."""
    return F.get(F.filter(samples, lambda s: s["measurand"].isin(measurands)), F.lit(0))["value"].try_cast("double")


def number_text(value: Column) -> Column:
    """Text of a JSON value of any type: a number loses its fraction, a string stays as it is."""
    text = F.try_variant_get(value, "$", "string")
    whole = F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint")).cast("string")
    return F.when(F.schema_of_variant(value) == "STRING", text).otherwise(whole)


def whole_number(text: Column, kind: str) -> Column:
    """Integer from the text of a JSON value; null for a string that holds no integer, such as "3.7"."""
    return text.try_cast(kind)


def session_id(charger: Column, transaction: Column) -> Column:
    return F.concat_ws("_", charger, transaction)
