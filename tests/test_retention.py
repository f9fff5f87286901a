import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from voltlane.operators import filters, retention

AS_OF = datetime(2025, 5, 20, 14, 30)
SCHEMA = "id long, eventTime timestamp, note string"


def rows():
    hours = [datetime(2025, 5, d, h, 30) for d in (9, 15, 16, 17, 18, 20) for h in (0, 13, 14, 15, 23)]
    return [(k, t, "x") for k, t in enumerate(hours)]


def table(spark, path, batches):
    df = spark.createDataFrame(rows(), SCHEMA)
    for b in range(batches):
        part = df.filter(F.col("id") % batches == b)
        retention.write_days(part, path, batch_id=b if batches > 1 else None)
    return df


def ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).select("id").collect())


def wanted(df, days=3):
    return sorted(r.id for r in filters.retained(df, "eventTime", F.lit(AS_OF), days).collect())


def files_of(path, day):
    return sorted(f for _, _, names in os.walk(f"{path}/day={day}") for f in names if f.endswith(".parquet"))


@pytest.mark.parametrize("batches", [1, 3])
def test_old_days_go_and_only_the_boundary_day_is_rewritten(spark, tmp_path, batches):
    path = str(tmp_path / "log")
    df = table(spark, path, batches)
    before = {day: files_of(path, day) for day in ("2025-05-17", "2025-05-18", "2025-05-20")}
    assert retention.purge(spark, path, AS_OF, 3) == ["2025-05-09", "2025-05-15", "2025-05-16", "2025-05-17"]
    assert ids(spark, path) == wanted(df)
    assert sorted(d for d in os.listdir(path) if d.startswith("day=")) == ["day=2025-05-17", "day=2025-05-18", "day=2025-05-20"]
    assert files_of(path, "2025-05-17") != before["2025-05-17"]
    assert all(files_of(path, day) == before[day] for day in ("2025-05-18", "2025-05-20"))
    assert not [d for d in os.listdir(path) if d.startswith("_purge")]
    # Nothing more to do.
    assert retention.purge(spark, path, F.lit(AS_OF), 3) == []
    assert files_of(path, "2025-05-18") == before["2025-05-18"]


def test_a_boundary_day_of_which_nothing_stays(spark, tmp_path):
    path = str(tmp_path / "log")
    retention.write_days(spark.createDataFrame(rows()[:5], SCHEMA), path)
    assert retention.purge(spark, path, datetime(2025, 5, 12, 23, 45), 3) == ["2025-05-09"]
    assert [d for d in os.listdir(path) if d.startswith("day=")] == []


def test_rows_at_the_limit_and_without_a_time_stay(spark, tmp_path):
    path = str(tmp_path / "log")
    table = [(1, datetime(2025, 5, 17, 14, 30), "at"), (2, datetime(2025, 5, 17, 14, 29, 59), "before"), (3, None, "untimed")]
    retention.write_days(spark.createDataFrame(table, SCHEMA), path)
    retention.purge(spark, path, AS_OF, 3)
    assert ids(spark, path) == [1, 3]


@pytest.mark.parametrize("step", ["_replace", "delete_days", "delete_copy"])
def test_a_purge_that_broke_off_ends_the_same(spark, tmp_path, monkeypatch, step):
    """It fails before the day is replaced, after that, or while old days are deleted; then another one runs, with a
    later limit."""
    path = str(tmp_path / "log")
    df = table(spark, path, 2)
    with monkeypatch.context() as m:
        if step == "_replace":
            # The day's files are gone and the new ones are not there yet.
            def broken(df, path, parts):
                retention.Files(spark, path).delete("day=2025-05-17")
                raise OSError("lost")

            m.setattr(retention, "_replace", broken)
        else:
            delete = retention.Files.delete

            def failing(self, *names):
                if names[0].startswith("_purge") == (step == "delete_copy"):
                    raise OSError("lost")
                delete(self, *names)

            m.setattr(retention.Files, "delete", failing)
        with pytest.raises(OSError):
            retention.purge(spark, path, AS_OF, 3)
    retention.purge(spark, path, AS_OF, 3)
    assert ids(spark, path) == wanted(df)
    retention.purge(spark, path, AS_OF, 2)
    assert ids(spark, path) == wanted(df, 2)


def test_a_copy_that_is_not_complete_does_not_count(spark, tmp_path):
    path = str(tmp_path / "log")
    df = table(spark, path, 1)
    os.makedirs(f"{path}/_purge-2025-05-18/day=2025-05-18")
    retention.purge(spark, path, AS_OF, 3)
    assert ids(spark, path) == wanted(df)


def test_a_repeated_batch_replaces_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    df = table(spark, path, 2)
    retention.write_days(df.filter("id % 2 = 1"), path, batch_id=1)
    assert ids(spark, path) == [r[0] for r in rows()]
