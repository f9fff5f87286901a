"""Requests and their responses.

Pairing is one grouped aggregation on the call id, not two de-duplications and a full outer join: one shuffle,
reduced on the map side first, so an id that fills a third of a log costs one row per task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.functions.calls import call_elements

PAIR, LONE_REQUEST, LONE_RESPONSE, REJECT = "pair", "unpaired_request", "unpaired_response", "reject"


def _scope(pair_scope):
    return {"file": ["file", "uniqueId"], "global": ["uniqueId"]}[pair_scope]


def _order(pair_scope):
    return F.col("ord") if pair_scope == "file" else F.struct("file", "ord")


def _last(kind, pair_scope):
    is_kind = F.col("kind") == kind
    return F.max_by(F.when(is_kind, F.struct("chargerId", "message")), F.when(is_kind, _order(pair_scope)))


def status_of(request: Column, response: Column) -> Column:
    both = F.when(request.isNotNull() & response.isNotNull(), PAIR)
    return both.when(request.isNotNull(), LONE_REQUEST).otherwise(LONE_RESPONSE)


def _status():
    return status_of(F.col("req"), F.col("resp"))


def match_calls(parsed: DataFrame, pair_scope: str = "file") -> DataFrame:
    """One row per call id with its last request and last response, and whether both exist."""
    calls = parsed.filter(F.col("kind") != "reject")
    grouped = calls.groupBy(*_scope(pair_scope)).agg(
        _last("request", pair_scope).alias("req"), _last("response", pair_scope).alias("resp")
    )
    return grouped.select(
        *_scope(pair_scope),
        F.coalesce("req.chargerId", "resp.chargerId").alias("chargerId"),
        F.col("req.message").alias("request"),
        F.col("resp.message").alias("response"),
        _status().alias("status"),
    )


def outcomes(parsed: DataFrame, pair_scope: str = "file") -> DataFrame:
    """Pairs, lone calls and rejected lines from a single pass over the log. A rejected line is a group of its
    own, keyed by its place in the file."""
    is_reject = F.col("kind") == "reject"
    place = F.when(is_reject, F.struct("file", "ord")).alias("place")
    keys = [F.when(~is_reject, F.col(k)).alias(k) for k in _scope(pair_scope)]
    grouped = parsed.groupBy(place, *keys).agg(
        _last("request", pair_scope).alias("req"),
        _last("response", pair_scope).alias("resp"),
        F.max(F.when(is_reject, F.col("line"))).alias("line"),
        F.max("reason").alias("reason"),
    )
    status = F.when(F.col("reason").isNotNull(), REJECT).otherwise(_status())
    return grouped.select(
        "uniqueId",
        F.coalesce("req.chargerId", "resp.chargerId").alias("chargerId"),
        F.col("req.message").alias("request"),
        F.col("resp.message").alias("response"),
        "line",
        status.alias("status"),
        F.coalesce(
            "reason",
            F.when(status == LONE_REQUEST, S.UNPAIRED_REQUEST).when(status == LONE_RESPONSE, S.UNPAIRED_RESPONSE),
        ).alias("reason"),
    )


def pairs(matched: DataFrame) -> DataFrame:
    return matched.filter(F.col("status") == PAIR)


def unpaired_requests(matched: DataFrame) -> DataFrame:
    return matched.filter(F.col("status") == LONE_REQUEST)


def unpaired_responses(matched: DataFrame) -> DataFrame:
    return matched.filter(F.col("status") == LONE_RESPONSE)


def request_has_response(matched: DataFrame) -> DataFrame:
    """Each request with a flag telling whether its response exists."""
    requests = matched.filter(F.col("status") != LONE_RESPONSE)
    return requests.withColumn("hasResponse", F.col("status") == PAIR).drop("status")


def response_transaction_id(response):
    """The transactionId a response carries in its payload (third element)."""
    return F.get_json_object(F.get(call_elements(response), F.lit(2)), "$.transactionId")


def ingest_counts(all_outcomes: DataFrame) -> DataFrame:
    """Number of pairs, lone calls and rejected lines, by reason."""
    return all_outcomes.groupBy("status", "reason").agg(F.count("*").alias("n"))
