"""Requests and responses of a live log."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.operators import pairing, topics


LATE = "late"
CALL = ["uniqueId", "chargerId", "request", "response", "line", "status", "reason"]


def _scope(parsed: DataFrame, pair_scope: str) -> list[str]:
    return ["file", "uniqueId"] if pair_scope == "file" and "file" in parsed.columns else ["uniqueId"]


def _reason(status: Column) -> Column:
    lone = F.when(status == pairing.LONE_REQUEST, S.UNPAIRED_REQUEST)
    return lone.when(status == pairing.LONE_RESPONSE, S.UNPAIRED_RESPONSE)


def _rejected(parsed: DataFrame) -> DataFrame:
    nothing = [F.lit(None).cast("string").alias(c) for c in ("uniqueId", "chargerId", "request", "response")]
    rejected = parsed.filter(F.col("kind") == "reject")
    return rejected.select(*nothing, "line", F.lit(pairing.REJECT).alias("status"), "reason")


def match_stream(parsed: DataFrame, wait: str = "10 minutes", pair_scope: str = "file") -> DataFrame:
    """The columns of ``pairing.outcomes`` over a stream: pairs, lone calls and rejected lines.

    ``parsed`` has an ``arrival`` timestamp and ``ord``, the place of a line in its file, as ``read_log_stream`` gives
    them. Calls of one id that follow each other within ``wait`` belong together; of repeated requests or responses the
    last one counts, as in a batch, and ``ord`` says which one that is where several arrive at once. An id comes out once
    ``wait`` has passed without another call of it. It is one grouped aggregation over session windows, in append mode;
    Spark merges the calls of an id on the map side first (see ``use_local_merge``). Rejected lines come out at once.
    ``pair_scope`` is ``file`` or ``global``, as in a batch; a stream without a ``file`` column has one scope."""
    if "ord" not in parsed.columns:
        raise ValueError("lines of a stream need their place in the file, ord, to tell which of two calls is the last")
    keys = _scope(parsed, pair_scope)
    order = F.struct("arrival", *[c for c in ("file", "ord") if c in parsed.columns])
    calls = parsed.filter(F.col("kind") != "reject").withWatermark("arrival", wait)

    def last(kind):
        is_kind = F.col("kind") == kind
        return F.max_by(F.when(is_kind, F.struct("chargerId", "message")), F.when(is_kind, order))

    matched = calls.groupBy(*keys, F.session_window("arrival", wait)).agg(
        last("request").alias("req"), last("response").alias("resp")
    )
    status = pairing.status_of(F.col("req"), F.col("resp"))
    matched = matched.select(
        "uniqueId",
        F.coalesce("req.chargerId", "resp.chargerId").alias("chargerId"),
        F.col("req.message").alias("request"),
        F.col("resp.message").alias("response"),
        F.lit(None).cast("string").alias("line"),
        status.alias("status"),
        _reason(status).alias("reason"),
    )
    return matched.unionByName(_rejected(parsed))


def join_stream(
    parsed: DataFrame,
    wait: str = "10 minutes",
    pair_scope: str = "file",
    late_after: str | None = None,
    requests: DataFrame | None = None,
) -> DataFrame:
    """Requests and responses as two streams, joined within ``wait`` of each other: pairs, lone calls, rejected and late
    lines, with the places (file and ord) of the lines that each row is made of.

    A pair comes out as soon as its second call arrives; ``match_stream`` waits, since it lets the last of repeated calls
    win. Here each call counts: a request that is repeated, or has several responses, makes several pairs. A lone call
    comes out once ``wait`` has passed. ``parsed`` holds both kinds; if the requests come from a stream of their own, it is
    given as ``requests``.

    A line whose file is older than ``late_after`` when it arrives is not joined, but comes out as ``late``, with its text;
    its counterpart may have come out as a lone call long before. So every line of the input is in some row of the result,
    by its place, and none is lost behind the watermark: ``arrival`` is the time of the batch, which only rises. Run it
    under ``use_one_clock``."""
    wait_ = F.expr(f"INTERVAL {wait}")
    both = [parsed] if requests is None else [parsed, requests]

    def late(df: DataFrame) -> Column:
        if late_after is None or "written" not in df.columns:
            return F.lit(False)
        return F.coalesce(F.col("written") < F.col("arrival") - F.expr(f"INTERVAL {late_after}"), F.lit(False))

    keys = _scope(parsed, pair_scope)

    def side(df: DataFrame, kind: str, name: str) -> DataFrame:
        """Of one kind, under names of its own. The name of the file, long and in the state's keys several times, stands once
        in a row of the state; the key has its hash."""
        rows = df.filter((F.col("kind") == kind) & ~late(df)).withWatermark("arrival", "0 seconds")
        return rows.select(
            F.xxhash64("file" if "file" in keys else F.lit(0)).alias(f"{name}_hash"),
            *[F.col(c).alias(f"{name}_{c}") for c in ("uniqueId", "arrival", "file", "ord") if c in df.columns],
            F.struct("chargerId", "message").alias(name),
        )

    def place_of(df: DataFrame, name: str) -> Column:
        at = [F.col(f"{name}_{c}").alias(c) for c in ("file", "ord") if c in df.columns]
        return F.when(F.col(name).isNotNull(), F.struct(*at))

    left, right = side(both[-1], "request", "req"), side(parsed, "response", "resp")
    on = (F.col("req_hash") == F.col("resp_hash")) & (F.col("req_uniqueId") == F.col("resp_uniqueId"))
    if "file" in keys:
        # The same file, not only its hash; said so that it does not become a key.
        on = on & F.col("req_file").between(F.col("resp_file"), F.col("resp_file"))
    on = on & F.col("resp_arrival").between(F.col("req_arrival") - wait_, F.col("req_arrival") + wait_)
    status = pairing.status_of(F.col("req"), F.col("resp"))
    joined = left.join(right, on, "full_outer").select(
        F.coalesce("req_uniqueId", "resp_uniqueId").alias("uniqueId"),
        F.coalesce("req.chargerId", "resp.chargerId").alias("chargerId"),
        F.col("req.message").alias("request"),
        F.col("resp.message").alias("response"),
        F.lit(None).cast("string").alias("line"),
        status.alias("status"),
        _reason(status).alias("reason"),
        F.filter(F.array(place_of(both[-1], "req"), place_of(parsed, "resp")), lambda p: p.isNotNull()).alias("places"),
    )

    def alone(df: DataFrame, rows: Column, status: str) -> DataFrame:
        empty = [F.lit(None).cast("string").alias(c) for c in ("request", "response")]
        place = F.struct(*[c for c in ("file", "ord") if c in df.columns])
        call = ["uniqueId", "chargerId"] if status == LATE else [F.lit(None).cast("string").alias(c) for c in CALL[:2]]
        reason = F.lit("late").alias("reason") if status == LATE else "reason"
        return df.filter(rows).select(*call, *empty, "line", F.lit(status).alias("status"), reason, F.array(place).alias("places"))

    out = joined
    for df in both:
        is_reject = F.col("kind") == "reject"
        out = out.unionByName(alone(df, is_reject, pairing.REJECT))
        if late_after is not None:
            out = out.unionByName(alone(df, ~is_reject & late(df), LATE))
    return out


def use_local_merge(spark) -> None:
    """Merge the calls of an id inside each task before the shuffle, so an id that fills the log is no single task."""
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")


def use_one_clock(spark) -> None:
    """Lets lone requests out even while no response arrives, and the other way round: the time of the batch is the same
    for both sides of ``join_stream``, so the later watermark holds for both."""
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")


def start_ingest(
    parsed: DataFrame,
    sinks: dict,
    checkpoint: str,
    wait: str = "10 minutes",
    pair_scope: str = "file",
    at_once: bool = False,
    late_after: str | None = None,
    **trigger,
):
    """A live log to the message topic and the dead-letter topic. ``sinks`` has ``messages`` and ``dead``, functions of
    a DataFrame of topic, key and value and the number of the batch.

    ``at_once`` pairs by ``join_stream``, which sends a pair as soon as it is complete; with ``late_after`` lines of old
    files go to the sink ``late`` (uniqueId, chargerId, line)."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            on_time = batch.filter(F.col("status") != LATE)
            sinks["messages"](topics.to_message_log(on_time), batch_id)
            sinks["dead"](topics.to_dead_letter(on_time), batch_id)
            if late_after is not None:
                sinks["late"](batch.filter(F.col("status") == LATE).select("uniqueId", "chargerId", "line"), batch_id)
        finally:
            batch.unpersist()

    if late_after is not None and not at_once:
        raise ValueError("late_after needs at_once")
    use_one_clock(parsed.sparkSession) if at_once else use_local_merge(parsed.sparkSession)
    matched = join_stream(parsed, wait, pair_scope, late_after) if at_once else match_stream(parsed, wait, pair_scope)
    writer = matched.writeStream.outputMode("append").foreachBatch(sink)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
