"""Wall time of the main jobs over the events of $BENCH_SF_DIR, as one JSON line.

The message topic, the charger log and the live topics are written from the events first, outside the clock, so the
times are those of reading and computing, as on a real topic. Each job runs twice; the better run counts.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from voltlane.operators import lines, pairing, running, sessions, topics, tracker  # noqa: E402
from voltlane.plans import jobs, queries, views  # noqa: E402
from voltlane.scratch import scratch_folder  # noqa: E402
from voltlane.sources import events, logs, messages  # noqa: E402
from voltlane.streaming import job  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "4"))


def session():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "7g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def prepared(spark):
    """Folders of the message topic, the log files, the live topics and the typed messages; row counts."""
    source = events.read_events(spark, FOLDER)
    folders = {name: scratch_folder(spark, name) for name in ("topic", "log", "live", "typed")}
    events.event_records(source).write.parquet(folders["topic"])
    events.event_lines(source).select("line").write.text(folders["log"])
    queries._live_records(spark, FOLDER).repartition(CPUS, "key").write.parquet(folders["live"])
    topic = messages.read_messages_batch(spark, folders["topic"], "parquet")
    jobs.typed_sessions(topic).drop("message").write.parquet(folders["typed"])
    return folders, {"messages": topic.count(), "lines": spark.read.text(folders["log"]).count()}


def main():
    spark = session()
    folders, rows = prepared(spark)
    topic = lambda: messages.read_messages_batch(spark, folders["topic"], "parquet")
    parsed = lambda: lines.parse_lines(logs.read_log(spark, folders["log"]))
    typed = lambda: spark.read.parquet(folders["typed"])
    live = lambda: spark.read.parquet(folders["live"])

    def stream(start):
        out = scratch_folder(spark, "stream")
        source = messages.read_messages_stream(spark, folders["topic"], "parquet")
        job.use_rocksdb(spark)
        started = start(jobs.typed_sessions(source), job.file_sinks(out), out + "/checkpoint", availableNow=True)
        started.awaitTermination()

    def stream_in_batches(stream, sinks, checkpoint, **trigger):
        return job.start_lifecycle_in_batches(stream, sinks, checkpoint + "-state", checkpoint, buckets=CPUS, **trigger)

    timed = {
        "decode_typed": lambda: messages.decode_messages(topic()),
        "pairs": lambda: pairing.match_calls(parsed()),
        "ingest_outcomes": lambda: pairing.outcomes(parsed()),
        "completed_sessions": lambda: jobs.completed_from_log(topic()),
        "completed_from_typed": lambda: sessions.completed_sessions(typed()),
        "running_state": lambda: running.running_state(jobs.typed_sessions(topic())),
        "running_state_replay": lambda: running.running_state_replay(typed()),
        "track_sessions": lambda: tracker.track_sessions(messages.decode_payloads(topic())),
        "compacted_view": lambda: topics.compacted_view(live()),
        "raw_after_tombstone": lambda: topics.after_last_tombstone(live()),
        "sessions_by_day_station": lambda: views.sessions_by(sessions.completed_sessions(typed())),
        "stream_sessions": lambda: stream(job.start_sessions),
        "stream_lifecycle": lambda: stream(job.start_lifecycle),
        "stream_lifecycle_batches": lambda: stream(stream_in_batches),
    }
    seconds = {}
    for name, run in timed.items():
        for _ in range(2):
            start = time.perf_counter()
            result = run()
            if result is not None:
                result.write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            seconds[name] = round(min(took, seconds.get(name, took)), 3)
    per_second = {
        name: round(rows["lines" if name in ("pairs", "ingest_outcomes") else "messages"] / sec)
        for name, sec in seconds.items()
    }
    print(
        json.dumps(
            {
                "metric": "total wall time of the main jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": per_second,
                "rows": rows,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
