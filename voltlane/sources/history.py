"""The completed-session table."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from voltlane import schemas as S
from voltlane.operators.tables import last_per_key


def read_history(spark: SparkSession, path: str | None = None, format: str = "parquet", **options) -> DataFrame:
    """Completed sessions.

    A Parquet folder written per batch holds several versions of a session; the newest wins. A plain folder, or one
    partitioned by ``day``, has one row per session and is read as it is, so filters reach the files and days that are
    not asked for are not read. Any other source, such as JDBC, is read as it is too."""
    if format != "parquet":
        return spark.read.format(format).options(**options).load()
    try:
        table = spark.read.options(**options).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.schema(S.HISTORY).parquet(path)  # no batch has been written yet
    if missing := [c for c in S.columns(S.HISTORY) if c not in table.columns]:
        raise ValueError(f"{path} is no session table: it lacks {', '.join(missing)}")
    if "batch_id" not in table.columns:
        return table
    return last_per_key(table, ["sessionId"], "batch_id").drop("batch_id")
