"""Tables partitioned by day, and the physical removal of what is too old.

A purge deletes whole days and rewrites only the day that the limit falls into; later days are not even read. What stays
of that day is first written beside the table, in a folder that readers do not see, and only then takes the old day's
place. So a purge that broke off at any point ends the same when it, or a later one, is run again: until the copy is
complete the table is as it was, and afterwards the copy is what counts.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlane.operators.filters import retained

DAY = "day"
PENDING = "_purge-"


def write_days(df: DataFrame, path: str, column: str = "eventTime", batch_id: int | None = None) -> None:
    """Add rows to a table partitioned by the day of ``column``. With ``batch_id``, as a sink gets it, a batch that is
    repeated replaces its own files and no others. Rows without a time go to a partition of their own."""
    daily = df.withColumn(DAY, F.to_date(column))
    if batch_id is None:
        daily.write.mode("append").partitionBy(DAY).parquet(path)
    else:
        _replace(daily.withColumn("batch_id", F.lit(batch_id).cast("long")), path, [DAY, "batch_id"])


def _replace(df: DataFrame, path: str, parts: list[str]) -> None:
    """The partitions that ``df`` has rows for, anew; the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


class Files:
    """Folders of a table, on whatever file system it lies."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.at = lambda *names: jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *names]))
        self.system = self.at().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def folders(self, *names) -> list[str]:
        place = self.at(*names)
        if not self.system.exists(place):
            return []
        return sorted(s.getPath().getName() for s in self.system.listStatus(place) if s.isDirectory())

    def exists(self, *names) -> bool:
        return self.system.exists(self.at(*names))

    def delete(self, *names) -> None:
        self.system.delete(self.at(*names), True)


def purge(spark: SparkSession, path: str, as_of: Column | datetime, days: int, column: str = "eventTime") -> list[str]:
    """Remove the rows of a table of ``write_days`` that are older than ``days`` before ``as_of``; the names of the days
    that went, wholly or in part. The rows that stay are those that ``filters.retained`` keeps.

    Rows without a time stay in their partition, as nothing says that they are old. One purge runs at a time, and while it
    runs nothing is written to the day of the limit or before."""
    files = Files(spark, path)
    limit = (as_of if isinstance(as_of, Column) else F.lit(as_of)) - F.make_dt_interval(F.lit(days))
    last = spark.range(1).select(F.date_format(limit, "yyyy-MM-dd")).first()[0]
    gone = [_finished(spark, path, files, name, column) for name in files.folders() if name.startswith(PENDING)]
    boundary, pending = f"{DAY}={last}", PENDING + last
    if boundary in files.folders():
        day = spark.read.option("basePath", path).parquet(f"{path}/{boundary}")
        if not day.filter(F.col(column) < limit).isEmpty():
            parts = [DAY] + [c for c in ("batch_id",) if c in day.columns]
            kept = retained(day, column, F.lit(as_of) if isinstance(as_of, datetime) else as_of, days)
            kept.write.mode("overwrite").partitionBy(*parts).parquet(f"{path}/{pending}")
            gone.append(_finished(spark, path, files, pending, column))
    # Names of days sort by time, and that of the rows without a time after all of them.
    old = [name for name in files.folders() if name.startswith(f"{DAY}=") and name < boundary]
    for name in old:
        files.delete(name)
    return sorted({name.removeprefix(f"{DAY}=") for name in [*old, *filter(None, gone)]})


def _finished(spark: SparkSession, path: str, files: Files, pending: str, column: str) -> str | None:
    """Put the copy of a day in the place of the day; a copy that is not complete is thrown away."""
    day = f"{DAY}={pending.removeprefix(PENDING)}"
    complete = files.exists(pending, "_SUCCESS")
    if complete:
        by_batch = [name for name in files.folders(pending, day) if name.startswith("batch_id=")]
        for name in files.folders(day):
            if name not in by_batch:
                files.delete(day, name)
        if files.folders(pending):
            kept = spark.read.option("basePath", f"{path}/{pending}").parquet(f"{path}/{pending}")
            _replace(kept, path, [DAY, "batch_id"] if by_batch else [DAY])
        else:
            files.delete(day)
    files.delete(pending)
    return day if complete else None
