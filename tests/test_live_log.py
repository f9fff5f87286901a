"""Log files as a stream: the place of each line, pairs as in a batch, and no line lost."""

import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from voltlane.operators import lines, pairing
from voltlane.sources import logs
from voltlane.streaming import job
from voltlane.streaming import pairing as live


@pytest.fixture(autouse=True)
def rocksdb(spark):
    job.use_rocksdb(spark)
    live.use_one_clock(spark)
    yield
    spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")


def write(folder, name, content, age=0):
    folder.mkdir(exist_ok=True)
    path = folder / name
    # A file that is still being written must not be read.
    hidden = folder / f".{name}"
    hidden.write_text("\n".join(content) + "\n")
    os.utime(hidden, (time.time() - age,) * 2)
    hidden.rename(path)


def clock():
    """Files called ``closing`` come a day later than all the others."""
    late = F.col("_metadata.file_path").contains("closing")
    return F.current_timestamp() + F.when(late, F.expr("INTERVAL 1 DAY")).otherwise(F.expr("INTERVAL 0 DAY"))


def run(spark, folder, out, matched):
    parsed = lines.parse_lines(logs.read_log_stream(spark, str(folder), clock=clock()))
    writer = matched(parsed).writeStream.format("parquet").option("path", out).outputMode("append")
    writer.option("checkpointLocation", out + "-cp").trigger(availableNow=True).start().awaitTermination()


def batch(spark, folder):
    return lines.parse_lines(logs.read_log(spark, str(folder)))


FILES = {
    "a.txt": ['c : [2,"1","zzz first",{}]', 'c : [2,"1","aaa last",{}]', "# note", 'c : [3,"1",{"n":2}]', 'c : [3,"1",{"n":1}]',
              'c : [2,"lone","A",{}]', "no call", 'c : [3,"only",{}]'],
    "b.txt": ['d : [3,"1",{}]', 'd : [2,"1","A",{}]', 'd : [2,"x","B",{}]', "", 'd : [3,"x",{}]'],
}
CLOSING = ['clock : [2,"last","Heartbeat",{}]']


def test_lines_have_their_place_across_splits_and_batches(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        for name in ("a.txt", "b.txt"):
            write(folder, name, [f"{name}{k}" if k % 5 else "# none" for k in range(3000)])
            stream = logs.read_log_stream(spark, str(folder))
            writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-cp")
            writer.trigger(availableNow=True).start().awaitTermination()
        rows = spark.read.parquet(out).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len({r.ord.block for r in rows}) > 2
    for name in ("a.txt", "b.txt"):
        own = sorted((r.ord.block, r.ord.line, r.line) for r in rows if r.file.endswith(name))
        assert [line for _, _, line in own] == [f"{name}{k}" for k in range(3000) if k % 5]
    assert {r.written <= r.arrival for r in rows} == {True}


def test_the_last_of_repeated_calls_wins_as_in_a_batch(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    for name, content in FILES.items():
        # One of the files was copied in with an old time.
        write(folder, name, content, age=7 * 86400 if name == "b.txt" else 0)
        run(spark, folder, out, live.match_stream)
    want = pairing.outcomes(batch(spark, folder))
    write(folder, "closing.txt", CLOSING)
    run(spark, folder, out, live.match_stream)
    got = spark.read.parquet(out).filter("chargerId is null or chargerId <> 'clock'")
    columns = ["uniqueId", "chargerId", "request", "response", "line", "status", "reason"]
    assert got.select(*columns).exceptAll(want.select(*columns)).count() == 0
    assert want.select(*columns).exceptAll(got.select(*columns)).count() == 0
    assert [r.request for r in got.filter("uniqueId = '1' and chargerId = 'c'").collect()] == ['[2,"1","aaa last",{}]']


def test_input_without_places_is_refused(spark):
    parsed = lines.parse_lines(spark.createDataFrame([("a : [2,\"1\",\"A\",{}]",)], "line string"))
    with pytest.raises(ValueError, match="ord"):
        live.match_stream(parsed.withColumn("arrival", F.current_timestamp()))


def test_pairs_lone_calls_and_late_lines_are_all_lines(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    by_join = lambda parsed: live.join_stream(parsed, "10 minutes", late_after="2 days")
    write(folder, "a.txt", FILES["a.txt"])
    run(spark, folder, out, by_join)
    # Pairs and rejected lines are out already, lone calls are not.
    first = Counter(r.status for r in spark.read.parquet(out).collect())
    assert first == {"pair": 4, "reject": 1}
    write(folder, "b.txt", FILES["b.txt"], age=7 * 86400)
    run(spark, folder, out, by_join)
    write(folder, "closing.txt", CLOSING)
    run(spark, folder, out, by_join)
    rows = [r for r in spark.read.parquet(out).collect() if r.chargerId != "clock"]
    assert Counter(r.status for r in rows) == {"pair": 4, "reject": 1, "unpaired_request": 1, "unpaired_response": 1, "late": 4}
    assert {r.uniqueId for r in rows if r.status == "late"} == {"1", "x"}
    out_places = {(p.file, p.ord) for r in rows for p in r.places}
    read = logs.read_log(spark, str(folder)).filter(~F.col("file").contains("closing"))
    lines_in = {(r.file.rsplit("/", 1)[1], r.line) for r in read.collect()}
    assert len(out_places) == len(lines_in) == read.count()
    late = {r.line for r in rows if r.status == "late"}
    assert late == {line for file, line in lines_in if file == "b.txt"}


def test_requests_and_responses_from_two_folders(spark, tmp_path):
    out = str(tmp_path / "out")
    asked, answered = tmp_path / "asked", tmp_path / "answered"

    def step():
        read = lambda folder: lines.parse_lines(logs.read_log_stream(spark, str(folder), clock=clock()))
        joined = live.join_stream(read(answered), "10 minutes", "global", requests=read(asked))
        writer = joined.writeStream.format("parquet").option("path", out).outputMode("append")
        writer.option("checkpointLocation", out + "-cp").trigger(availableNow=True).start().awaitTermination()

    write(asked, "a.txt", ['c : [2,"1","A",{}]', 'c : [2,"2","A",{}]'])
    write(answered, "a.txt", ['c : [3,"9",{}]', "junk"])
    step()
    write(answered, "b.txt", ['c : [3,"1",{"ok":1}]'])
    step()
    # A line of one side is enough for both.
    write(asked, "closing.txt", CLOSING)
    step()
    rows = [r for r in spark.read.parquet(out).collect() if r.chargerId != "clock"]
    got = sorted((r.uniqueId or "", r.status, r.response) for r in rows)
    assert got == [("", "reject", None), ("1", "pair", '[3,"1",{"ok":1}]'), ("2", "unpaired_request", None),
                   ("9", "unpaired_response", '[3,"9",{}]')]


def test_ingest_at_once_writes_three_topics(spark, tmp_path):
    folder, out = tmp_path / "in", {name: [] for name in ("messages", "dead", "late")}
    sinks = {n: lambda df, i, n=n: out[n].extend(df.collect()) for n in out}
    write(folder, "a.txt", FILES["a.txt"])
    write(folder, "b.txt", FILES["b.txt"], age=7 * 86400)
    write(folder, "closing.txt", CLOSING)
    parsed = lines.parse_lines(logs.read_log_stream(spark, str(folder), clock=clock()))
    live.start_ingest(
        parsed, sinks, str(tmp_path / "cp"), at_once=True, late_after="2 days", availableNow=True
    ).awaitTermination()
    assert [r.key for r in out["messages"]] == ["1"] * 4
    assert len(out["dead"]) == 3 + 0 and len(out["late"]) == 4
    with pytest.raises(ValueError):
        live.start_ingest(parsed, sinks, "x", late_after="1 day")


def test_lines_are_parsed_once_however_often_a_stream_reads_them(spark, tmp_path):
    folder, kept, out = tmp_path / "in", str(tmp_path / "kept"), str(tmp_path / "out")
    write(folder, "a.txt", FILES["a.txt"])
    write(folder, "b.txt", FILES["b.txt"], age=7 * 86400)
    write(folder, "closing.txt", CLOSING)
    parsed = lines.parse_lines(logs.read_log_stream(spark, str(folder)))
    logs.keep_parsed(parsed, kept, kept + "-cp", availableNow=True).awaitTermination()
    day = F.when(F.col("file").contains("closing"), 1).otherwise(0)
    again = logs.read_parsed_stream(spark, kept, clock=F.current_timestamp() + F.make_dt_interval(day))
    assert set(again.columns) == set(parsed.columns)
    joined = live.join_stream(again, late_after="2 days")
    # The join reads its lines four times; none of them goes to the parser, or to Python, again.
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "literal_to_json" not in plan and "from_json" not in plan
    writer = joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-cp")
    writer.trigger(availableNow=True).start().awaitTermination()
    rows = [r for r in spark.read.parquet(out).collect() if r.chargerId != "clock"]
    assert Counter(r.status for r in rows) == {"pair": 4, "reject": 1, "unpaired_request": 1, "unpaired_response": 1, "late": 4}
    read = logs.read_log(spark, str(folder)).filter(~F.col("file").contains("closing"))
    assert len({(p.file, p.ord) for r in rows for p in r.places}) == read.count()


def test_the_query_parses_each_line_in_one_stream_alone(spark, tmp_path, monkeypatch):
    from voltlane.plans import queries

    row = "id event_id, timestamp'2024-01-05 10:00:00' ts, 1L user_id, 'view' event_type, 1.0D value, '{\"k\":1}' props"
    spark.sql(f"select {row} from range(40)").write.parquet(str(tmp_path / "events.parquet"))
    plans, parse = [], lines.parse_lines
    monkeypatch.setattr(queries.lines, "parse_lines", lambda df, *a, **k: plans.append(df) or parse(df, *a, **k))
    stream = queries._live_log(spark, str(tmp_path))
    assert len(plans) == 1 and stream.isStreaming
    assert "literal_to_json" not in stream._jdf.queryExecution().analyzed().toString()
