"""Keyed tables: newest row per key, alignment to a contract, changes, writers and export."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from voltlane import schemas as S


def last_per_key(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    """The row with the highest ``order`` of each key, reduced on the map side."""
    rest = [c for c in df.columns if c not in keys]
    by = F.col(order) if isinstance(order, str) else order
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns])


def aligned(df: DataFrame, ddl: str = S.HISTORY, defaults: dict | None = None) -> DataFrame:
    """The columns of a contract in its order and types; missing ones are null or take their default."""
    defaults = {"eventCount": 0} if defaults is None else defaults
    columns = []
    for field in StructType.fromDDL(ddl):
        value = F.col(field.name) if field.name in df.columns else F.lit(None)
        if field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]))
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def update_rows(df: DataFrame, where: Column, changes: dict[str, Column]) -> DataFrame:
    """Set columns on the matching rows."""
    hit = F.coalesce(where, F.lit(False))
    return df.select(*[F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else c for c in df.columns])


def delete_rows(df: DataFrame, where: Column) -> DataFrame:
    return df.filter(~F.coalesce(where, F.lit(False)))


def delete_keys(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return df.join(gone.select(key), key, "left_anti")


def keys_in_both(big: DataFrame, small: DataFrame, key: str = "sessionId") -> DataFrame:
    """Keys of ``small`` that ``big`` holds. ``small`` is the build side, so Spark can filter the big table in place
    where the small one is small enough to send around."""
    return big.select(key).join(small.select(key), key, "left_semi")


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str = "sessionId",
    on_conflict: str = "replace",
    order: str | Column | None = None,
) -> DataFrame:
    """One row per key: an update replaces the target's row, or is skipped where the key exists. Of several updates
    of a key the one of the highest ``order`` counts, by default the highest row."""
    rest = [c for c in updates.columns if c != key]
    updates = last_per_key(updates, [key], F.struct(*rest) if order is None else order)
    if on_conflict == "skip":
        return target.unionByName(updates.join(keys_in_both(target, updates, key), key, "left_anti"))
    return target.join(updates.select(key), key, "left_anti").unionByName(updates)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch to a Parquet table. Its folder is overwritten when the batch is run again, so a retry leaves
    no duplicates; readers take the newest version of a key."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def merge_statement(target: str, staging: str, columns: list[str], key: str = "sessionId") -> str:
    """Standard SQL that replaces the rows of ``target`` that ``staging`` has anew, and adds the others."""
    changes = ", ".join(f"{c} = s.{c}" for c in columns if c != key)
    return (
        f"MERGE INTO {target} t USING {staging} s ON t.{key} = s.{key} WHEN MATCHED THEN UPDATE SET {changes} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({', '.join(f's.{c}' for c in columns)})"
    )


def merge_once_statements(
    target: str, staging: str, ledger: str, columns: list[str], batch_id: int, job: str = "history", key: str = "sessionId"
) -> list[str]:
    """Statements for one transaction that bring a batch from ``staging`` (with a column batch_id) into ``target`` and enter
    it in ``ledger`` (job, batch_id). If the ledger has the batch, or a later one, neither changes anything; and rows that
    another batch left in ``staging`` are not taken for this one's."""
    new = f"NOT EXISTS (SELECT 1 FROM {ledger} l WHERE l.job = '{job}' AND l.batch_id >= {int(batch_id)})"
    source = f"(SELECT {', '.join(columns)} FROM {staging} WHERE batch_id = {int(batch_id)} AND {new})"
    return [
        merge_statement(target, source, columns, key),
        f"INSERT INTO {ledger} (job, batch_id) SELECT '{job}', {int(batch_id)} WHERE {new}",
    ]


def compact_batches(spark: SparkSession, path: str, target: str, **options) -> None:
    """The newest versions of a table written by batch, as a table partitioned by day at ``target``."""
    versions = spark.read.parquet(path)
    compact_table(last_per_key(versions, ["sessionId"], "batch_id").drop("batch_id"), target, **options)


def compact_table(
    df: DataFrame,
    path: str,
    date_column: str = "startTime",
    sort: tuple = ("stationId", "startTime"),
    files_per_day: int | None = None,
):
    """Rewrite a table partitioned by day and sorted inside files, so day and station filters skip data. A day has at
    most ``files_per_day`` files, by default as many as the session has shuffle partitions."""
    files = files_per_day or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    daily = df.withColumn("day", F.to_date(date_column))
    # A day spreads over several tasks by key, so one crowded day is no single task.
    spread = daily.repartition("day", F.pmod(F.xxhash64("sessionId"), F.lit(files)))
    spread.sortWithinPartitions("day", *sort).write.mode("overwrite").partitionBy("day").parquet(path)


def with_energy_unit(sessions: DataFrame, unit: str = "kWh") -> DataFrame:
    """totalEnergyConsumed as {value, unit}."""
    energy = F.struct(F.col("totalEnergyConsumed").alias("value"), F.lit(unit).alias("unit"))
    return sessions.withColumn("totalEnergyConsumed", energy)


def to_json_rows(sessions: DataFrame) -> DataFrame:
    """Sessions as JSON text, energy with its unit, empty fields written as null."""
    rows = with_energy_unit(sessions)
    return rows.select("sessionId", F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("json"))


def export(sessions: DataFrame, path: str, format: str = "json", **options) -> None:
    """Write sessions as JSON (energy with its unit), CSV or Parquet."""
    rows = with_energy_unit(sessions) if format == "json" else sessions
    rows.write.format(format).options(**options).save(path)
