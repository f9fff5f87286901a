"""A keyed table of Parquet files to which each batch is applied once.

Keys are dealt into buckets by hash. A batch rewrites the buckets that it has keys of, into a folder of its own, and then
commits by one file, its entry in the ledger: the number of the batch, and for every bucket the folder that holds it now.
The entry is checked before and created last, in one step that fails if it is there; so a batch that is repeated, after a
failure at any point, is applied exactly once, and readers see all of a batch or nothing. They take the files of the newest
entry, one row per key, without grouping the versions of all batches.
"""

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.operators.retention import Files
from voltlane.operators.tables import last_per_key, upsert
from voltlane.scratch import staged

LEDGER = "_applied"
BUCKETS = 64


def _entries(files: Files) -> list[int]:
    if not files.exists(LEDGER):
        return []
    names = [s.getPath().getName() for s in files.system.listStatus(files.at(LEDGER))]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _entry(spark: SparkSession, path: str, batch_id: int) -> dict:
    text = spark.read.text(f"{path.rstrip('/')}/{LEDGER}/{batch_id}.json", wholetext=True).first()[0]
    return json.loads(text)


def _commit(spark: SparkSession, files: Files, batch_id: int, entry: dict) -> None:
    """Write the entry beside the ledger, then move it in; the move fails if the entry is there."""
    draft, place = files.at(f"_draft-{batch_id}.json"), files.at(LEDGER, f"{batch_id}.json")
    out = files.system.create(draft, True)
    try:
        out.write(json.dumps(entry, sort_keys=True).encode())
    finally:
        out.close()
    files.system.mkdirs(files.at(LEDGER))
    if files.system.exists(place) or not files.system.rename(draft, place):
        raise RuntimeError(f"batch {batch_id} was applied by another writer at the same time")


def applied(spark: SparkSession, path: str) -> int | None:
    """The number of the last batch that was applied."""
    found = _entries(Files(spark, path))
    return found[-1] if found else None


def _rows(spark: SparkSession, path: str, entry: dict, buckets=None) -> DataFrame:
    """The table's rows, or those of some buckets, as of an entry."""
    held = {int(b): v for b, v in entry["buckets"].items() if buckets is None or int(b) in buckets}
    if not held:
        return spark.createDataFrame([], entry["schema"])
    paths = [f"{path.rstrip('/')}/batch={v}/bucket={b}" for b, v in sorted(held.items())]
    return spark.read.schema(entry["schema"]).parquet(*paths)


def read_versions(spark: SparkSession, path: str, as_of: int | None = None, empty: str = S.HISTORY) -> DataFrame:
    """One row per key: the table after its last batch, or after batch ``as_of`` if its files are still there. Before any
    batch it has the columns of ``empty`` and no rows."""
    found = [b for b in _entries(Files(spark, path)) if as_of is None or b <= as_of]
    return _rows(spark, path, _entry(spark, path, found[-1])) if found else spark.createDataFrame([], empty)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def apply_batch(
    updates: DataFrame,
    path: str,
    batch_id: int,
    key: str = "sessionId",
    order: str | Column | None = None,
    on_conflict: str = "replace",
    buckets: int = BUCKETS,
    merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    also: set[int] = frozenset(),
) -> bool:
    """Bring a batch into the table, as ``tables.upsert`` would, or ``merge`` of the rows of the touched buckets and the
    batch's; False if it, or a later one, was applied before. Buckets of ``also`` are written anew in any case.

    The first batch sets columns and number of buckets; ``buckets`` should keep a bucket to about a gigabyte. One writer at
    a time: of two that apply the same batch, one fails."""
    spark, files = updates.sparkSession, Files(updates.sparkSession, path)
    done = _entries(files)
    if done and batch_id <= done[-1]:
        return False
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in updates.schema)
    entry = _entry(spark, path, done[-1]) if done else {"schema": ddl, "buckets": {}, "of": buckets}
    columns = spark.createDataFrame([], entry["schema"]).columns
    rest = [c for c in updates.columns if c != key]
    newest = last_per_key(updates.select(*columns), [key], F.struct(*rest) if order is None else order)
    bucket = bucket_of(key, entry["of"])
    newest = staged(newest.withColumn("bucket", bucket), "updates")
    touched = {r["bucket"] for r in newest.select("bucket").distinct().collect()} | also
    old, new = _rows(spark, path, entry, touched), newest.drop("bucket")
    merged = upsert(old, new, key, on_conflict) if merge is None else merge(old, new)
    # A task for each bucket; all of a bucket's rows go into its files.
    merged = merged.withColumn("bucket", bucket).repartition(max(1, len(touched)), "bucket")
    merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{path.rstrip('/')}/batch={batch_id}")
    # A bucket may have lost all its rows.
    written = {n.removeprefix("bucket=") for n in files.folders(f"batch={batch_id}") if n.startswith("bucket=")}
    held = {b: v for b, v in entry["buckets"].items() if int(b) not in touched} | {b: batch_id for b in sorted(written)}
    _commit(spark, files, batch_id, entry | {"buckets": held})
    return True


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the files that the newest entry does not use, and the entries before it; the number of folders deleted. Not
    while somebody still reads an older state."""
    files = Files(spark, path)
    done = _entries(files)
    if not done:
        return 0
    held = {(v, int(b)) for b, v in _entry(spark, path, done[-1])["buckets"].items()}
    deleted = 0
    for folder in [n for n in files.folders() if n.startswith("batch=")]:
        batch = int(folder.removeprefix("batch="))
        if batch > done[-1]:
            continue  # being written
        for name in files.folders(folder):
            if name.startswith("bucket=") and (batch, int(name.removeprefix("bucket="))) not in held:
                files.delete(folder, name)
                deleted += 1
    for batch in done[:-1]:
        files.delete(LEDGER, f"{batch}.json")
    return deleted
