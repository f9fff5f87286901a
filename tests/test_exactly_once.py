"""Batches that are repeated after a failure, in a keyed table of files and in a database inside this process."""

import json
import os

import duckdb
import pytest
from helpers import full_session, records
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.operators import sessions, tables, versions
from voltlane.plans import jobs
from voltlane.sources import messages
from voltlane.streaming import job

DDL = "sessionId string, n long, note string"


def rows(spark, *values):
    return spark.createDataFrame(values, DDL)


def content(spark, path, **options):
    return {r.sessionId: (r.n, r.note) for r in versions.read_versions(spark, path, **options).collect()}


def test_batches_replace_and_add(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.read_versions(spark, path).count() == 0 and versions.applied(spark, path) is None
    assert versions.read_versions(spark, path).columns == S.columns(S.HISTORY)
    first = [(f"s{k}", k, None) for k in range(50)]
    assert versions.apply_batch(rows(spark, *first), path, 0, buckets=8)
    assert versions.apply_batch(rows(spark, ("s1", 100, "x"), ("new", 1, None), ("s1", 99, "y")), path, 1, order="n")
    want = {k: (n, note) for k, n, note in first} | {"s1": (100, "x"), "new": (1, None)}
    assert content(spark, path) == want
    assert versions.applied(spark, path) == 1
    # Only the buckets of these two keys were written again.
    assert len([d for d in os.listdir(f"{path}/batch=1") if d.startswith("bucket=")]) <= 2
    assert content(spark, path, as_of=0) == {k: (n, note) for k, n, note in first}


def test_skip_keeps_what_is_there(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.apply_batch(rows(spark, ("a", 1, None)), path, 0)
    versions.apply_batch(rows(spark, ("a", 2, None), ("b", 2, None)), path, 1, on_conflict="skip")
    assert content(spark, path) == {"a": (1, None), "b": (2, None)}


def test_a_repeated_batch_is_applied_once(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.apply_batch(rows(spark, ("a", 1, None)), path, 0)
    versions.apply_batch(rows(spark, ("a", 2, None)), path, 1)
    assert not versions.apply_batch(rows(spark, ("a", 1, None)), path, 0)
    assert not versions.apply_batch(rows(spark, ("a", 7, None)), path, 1)
    assert content(spark, path) == {"a": (2, None)}


def test_a_batch_without_rows_is_entered(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.apply_batch(rows(spark, ("a", 1, None)).limit(0), path, 0)
    assert versions.applied(spark, path) == 0 and content(spark, path) == {}
    versions.apply_batch(rows(spark, ("a", 1, None)), path, 1)
    assert content(spark, path) == {"a": (1, None)}


@pytest.mark.parametrize("point", ["before files", "before the entry", "entry half written"])
def test_a_failure_between_files_and_entry(spark, tmp_path, monkeypatch, point):
    path = str(tmp_path / "t")
    versions.apply_batch(rows(spark, ("a", 1, None), ("b", 1, None)), path, 0)
    with monkeypatch.context() as m:

        def lost(*args, **kw):
            if point == "entry half written":
                (tmp_path / "t" / "_draft-1.json").write_text('{"schema"')
            raise OSError("lost")

        m.setattr(versions, "upsert" if point == "before files" else "_commit", lost)
        with pytest.raises(OSError):
            # The first attempt had a row more, as it was cut at another place.
            versions.apply_batch(rows(spark, ("a", 2, None), ("c", 2, None)), path, 1)
    assert content(spark, path) == {"a": (1, None), "b": (1, None)}
    assert versions.apply_batch(rows(spark, ("a", 3, None)), path, 1)
    assert content(spark, path) == {"a": (3, None), "b": (1, None)}


def test_two_writers_of_a_batch(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.apply_batch(rows(spark, ("a", 1, None)), path, 0)
    commit = versions._commit

    def other_first(spark, files, batch_id, entry):
        commit(spark, files, batch_id, entry)
        commit(spark, files, batch_id, entry)

    monkeypatch.setattr(versions, "_commit", other_first)
    with pytest.raises(RuntimeError, match="another writer"):
        versions.apply_batch(rows(spark, ("a", 2, None)), path, 1)
    assert content(spark, path) == {"a": (2, None)}


def test_vacuum_leaves_what_is_in_use(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(4):
        versions.apply_batch(rows(spark, ("a", batch, None), (f"b{batch}", batch, None)), path, batch, buckets=4)
    before = content(spark, path)
    os.makedirs(f"{path}/batch=9/bucket=1")
    assert versions.vacuum(spark, path) > 0
    assert content(spark, path) == before and os.path.exists(f"{path}/batch=9/bucket=1")
    assert sorted(os.listdir(f"{path}/_applied"))[-1].endswith("3.json") and versions.vacuum(spark, path) == 0
    held = json.loads((tmp_path / "t" / "_applied" / "3.json").read_text())["buckets"]
    assert sum(len([b for b in os.listdir(f"{path}/{d}") if b.startswith("bucket=")]) for d in os.listdir(path)
               if d.startswith("batch=") and d != "batch=9") == len(held)


def test_a_stream_into_versions_equals_the_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    job.use_rocksdb(spark)
    sinks = job.file_sinks(out) | {"history": job.versioned_sink(out + "/versions", buckets=4)}
    parts = [full_session("a", "1") + full_session("b", "2")[:2], full_session("b", "2")[2:] + full_session("c", "3")]
    for i, part in enumerate(parts):
        records(spark, part).withColumn("offset", F.col("offset") + i * 100).coalesce(1).write.mode("append").parquet(source)
        typed = jobs.typed_sessions(messages.read_messages_stream(spark, source, "parquet"))
        job.start_sessions(typed, sinks, out + "/cp", availableNow=True).awaitTermination()
    want = sessions.completed_sessions(jobs.typed_sessions(messages.read_messages_batch(spark, source, "parquet")))
    got = versions.read_versions(spark, out + "/versions")
    assert got.columns == want.columns and got.count() == 3
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


# A database inside this process


@pytest.fixture
def database(tmp_path):
    con = duckdb.connect(str(tmp_path / "history.db"))
    con.execute('CREATE TABLE history ("sessionId" VARCHAR PRIMARY KEY, n BIGINT, note VARCHAR)')
    con.execute("CREATE TABLE applied (job VARCHAR, batch_id BIGINT, PRIMARY KEY (job, batch_id))")
    yield con
    con.close()


def transaction(con, staging, fail_after=None):
    def transact(spark, statements):
        con.execute(f"CREATE OR REPLACE VIEW staged AS SELECT * FROM read_parquet('{staging}/*.parquet')")
        con.begin()
        try:
            for k, statement in enumerate(statements):
                if fail_after == k:
                    raise OSError("lost")
                con.execute(statement)
            con.commit()
        except Exception:
            con.rollback()
            raise

    return transact


def in_database(con):
    return dict(con.execute('SELECT "sessionId", n FROM history').fetchall()), con.execute("SELECT batch_id FROM applied ORDER BY 1").fetchall()


def test_merge_once_in_a_database(spark, tmp_path, database):
    staging = str(tmp_path / "staging")

    def sink(fail_after=None):
        run = transaction(database, staging, fail_after)
        return job.merge_once_sink(run, "history", "staged", "applied", order="n", format="parquet", path=staging)

    sink()(rows(spark, ("a", 1, None), ("b", 1, None), ("a", 0, None)), 0)
    assert in_database(database) == ({"a": 1, "b": 1}, [(0,)])
    # Lost between staging and merge, then between the merge and the ledger.
    for k in (0, 1):
        with pytest.raises(OSError):
            sink(fail_after=k)(rows(spark, ("a", 2, None), ("c", 2, None)), 1)
        assert in_database(database) == ({"a": 1, "b": 1}, [(0,)])
    sink()(rows(spark, ("a", 2, None), ("c", 2, None)), 1)
    assert in_database(database) == ({"a": 2, "b": 1, "c": 2}, [(0,), (1,)])
    # Repeated after it was applied, when somebody has corrected the row.
    database.execute("UPDATE history SET n = 50 WHERE \"sessionId\" = 'a'")
    sink()(rows(spark, ("a", 2, None), ("c", 2, None)), 1)
    assert in_database(database) == ({"a": 50, "b": 1, "c": 2}, [(0,), (1,)])


def test_rows_of_another_batch_in_staging_are_not_taken(spark, tmp_path, database):
    staging = str(tmp_path / "staging")
    rows(spark, ("a", 9, None)).withColumn("batch_id", F.lit(7).cast("long")).write.parquet(staging)
    statements = tables.merge_once_statements("history", "staged", "applied", ["sessionId", "n", "note"], 3)
    transaction(database, staging)(spark, statements)
    assert in_database(database)[0] == {}
