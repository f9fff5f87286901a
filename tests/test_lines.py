import pytest
from pyspark.sql import functions as F

from voltlane.operators import lines, pairing, topics
from voltlane.plans import jobs
from voltlane.sources import logs

LOG = """# morning shift

pole-a : [2,"beat-7","Heartbeat",{ }]
pole-a : [3,"beat-7",{"currentTime":"2025-03-04T05:06:07.123456Z"}]
pole-b : [2,"20250304 051122334455Z","ChangeAvailability",{"connectorId":4}]
pole-b : [3,"20250304 051122334455Z",{}]
pole-c : [2,"asked-once","MeterValues",{"connectorId":2}]
pole-d : [3,"told-once",{}]
pole-e [2,"no-colon","Heartbeat",{ }]
pole-f :
pole-g : [2,"no-comma","Heartbeat"{ }]
pole-h : [2]
  pole-i: [9,"odd-kind","Heartbeat",{}]
pole-i: 5
pole-i: {"k":"v"}
pole-i: [2,"tail","Reset",{}] and more
pole-j : [2,"lit-1","Heartbeat",{'fine': True, 'empty': None}]
pole-j : [3,"lit-1",{}]
"""


@pytest.fixture
def log(spark, tmp_path):
    (tmp_path / "a.txt").write_text(LOG)
    return logs.read_log(spark, str(tmp_path / "a.txt"))


def by_body(parsed):
    return {(r.chargerId, r.uniqueId): r for r in parsed.collect()}


def test_blank_lines_and_comments_are_skipped(log):
    assert log.count() == 16
    assert log.filter(F.col("line").startswith(" ")).count() == 0


def test_kinds_and_reasons(log):
    found = lines.parse_lines(log, python_literals=True).groupBy("kind", "reason").count().collect()
    assert {(r.kind, r.reason): r["count"] for r in found} == {
        ("request", None): 4,
        ("response", None): 4,
        ("reject", "regex match failed"): 2,
        ("reject", "JSON/ast parsing failed"): 2,
        ("reject", "message too short"): 1,
        ("reject", "unknown message type: 9"): 1,
        ("reject", "not an array"): 2,
    }


def test_python_literals_are_rejected_unless_asked_for(log):
    rejected = lines.rejects(lines.parse_lines(log, python_literals=False)).filter(F.col("line").contains("lit-1"))
    assert [r.reason for r in rejected.collect()] == ["JSON/ast parsing failed"]


def test_pairs_and_lone_calls(log):
    matched = pairing.match_calls(lines.parse_lines(log, python_literals=True))
    assert {r.uniqueId for r in pairing.pairs(matched).collect()} == {
        "beat-7",
        "20250304T051122334455Z",
        "lit-1",
    }
    assert [r.uniqueId for r in pairing.unpaired_requests(matched).collect()] == ["asked-once"]
    assert [r.uniqueId for r in pairing.unpaired_responses(matched).collect()] == ["told-once"]


def test_one_pass_outcomes_agree_with_the_separate_operators(log):
    parsed = lines.parse_lines(log, python_literals=True)
    counts = {(r.status, r.reason): r.n for r in pairing.ingest_counts(pairing.outcomes(parsed)).collect()}
    assert counts[("pair", None)] == 3
    assert counts[("unpaired_request", "unpaired_request_no_response")] == 1
    assert counts[("unpaired_response", "unpaired_response_no_request")] == 1
    assert sum(n for (status, _), n in counts.items() if status == "reject") == lines.rejects(parsed).count()


def test_flat_parse_takes_short_calls(spark):
    rows = [("pole-x: [2,\"short-1\"]",), (': [2,"c"]',), ("pole-y: some words",), ("words alone",)]
    flat = lines.parse_flat(spark.createDataFrame(rows, "line string"))
    assert [(r.chargerId, r.uniqueId) for r in flat.collect()] == [("pole-x", "short-1")]


def test_empty_file(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    assert logs.read_log(spark, str(tmp_path / "empty.txt")).count() == 0


def test_last_call_of_an_id_wins_across_splits(spark, tmp_path):
    body = "".join(f'c{i % 7} : [2,"same","A{i}",{{"pad":"{"x" * 50}"}}]\n' for i in range(4000))
    (tmp_path / "big.txt").write_text(body + 'c : [3,"same",{}]\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        log = logs.read_log(spark, str(tmp_path))
        assert log.rdd.getNumPartitions() > 4
        pair = pairing.match_calls(lines.parse_lines(log)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(pair) == 1 and '"A3999"' in pair[0].request and pair[0].status == "pair"


def test_pairing_scope(spark, tmp_path):
    (tmp_path / "a.txt").write_text('c : [2,"1","A",{}]\n')
    (tmp_path / "b.txt").write_text('c : [3,"1",{}]\n')
    parsed = lines.parse_lines(logs.read_log(spark, str(tmp_path)))
    assert sorted(r.status for r in pairing.match_calls(parsed).collect()) == ["unpaired_request", "unpaired_response"]
    assert [r.status for r in pairing.match_calls(parsed, "global").collect()] == ["pair"]


def test_ingest_job(spark, tmp_path):
    (tmp_path / "a.txt").write_text(LOG)
    sinks = {"good": [], "bad": []}
    counts = jobs.ingest_logs(
        spark,
        str(tmp_path / "a.txt"),
        lambda df: sinks["good"].extend(df.collect()),
        lambda df: sinks["bad"].extend(df.collect()),
    )
    assert len(sinks["good"]) == 3 and len(sinks["bad"]) == 10
    assert sum(r.n for r in counts.collect()) == 13


def test_old_dead_letters_keep_the_quotes_of_the_id(log):
    letters = topics.to_dead_letter(pairing.outcomes(lines.parse_lines(log)), legacy_quoted_id=True)
    ids = letters.select(F.get_json_object("value", "$.uniqueId").alias("id")).collect()
    assert '"asked-once"' in [r.id for r in ids]
