"""Where intermediate tables go: the shared folder the cluster names in spark.checkpoint.dir."""

import gc
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_MADE: list[str] = []


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="voltlane-")


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under spark.checkpoint.dir. Only a session in one process may name none, as in tests: on a
    cluster, executors would write to and read from different disks."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _local_root()
    _MADE.append(f"{root.rstrip('/')}/voltlane-{label}-{uuid.uuid4().hex}")
    return _MADE[-1]


def clear_scratch(spark: SparkSession) -> int:
    """Delete the folders that this process has made, once no DataFrame that reads them is used any more; their
    number."""
    jvm, n = spark.sparkContext._jvm, len(_MADE)
    while _MADE:
        path = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back, so later branches share one result that a lost executor
    cannot change."""
    return staged_at(df, label)[0]


def staged_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``staged``, and the folder, for ``discard``."""
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``staged_at`` that nothing reads any more, not even to replace a lost result."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    if path in _MADE:
        _MADE.remove(path)


def free_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished queries deleted. Spark does so once nothing in the driver refers to a query any
    more, but notices only when the driver's memory is collected; many small queries in a row pile their files up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
