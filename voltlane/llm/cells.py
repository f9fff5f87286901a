"""Groups of rows for comparison, cut into cells of bounded size.

A group of up to ``limit`` rows is one cell. A larger group is dealt into blocks by hash, and there is a cell for every
two blocks and for each block with itself, so any two rows of a group meet in exactly one cell, and no task holds more
than two blocks. A cell compares rows in memory and passes on no pairs, only what it sums up for each row.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlane.llm.arrow import bounded, runs
from voltlane.llm.components import star_batches
from voltlane.scratch import staged

BROADCAST_GROUPS = 100_000


def dealt(rows: DataFrame, key: str, id: str, limit: int, sizes: DataFrame | None = None) -> DataFrame:
    """``rows`` by cell: columns ``key``, ``i``, ``j``, ``side`` (0 for block i, 1 for block j; 0 where they are the
    same), sorted by cell. ``sizes`` (key, n) tells the sizes of the groups, if they are known already."""
    sizes = sizes if sizes is not None else rows.groupBy(key).agg(F.count("*").alias("n"))
    large = staged(sizes.filter(F.col("n") > limit).select(F.col(key).alias("__key"), F.ceil(F.col("n") / limit).alias("__blocks")), "large")
    if large.count() <= BROADCAST_GROUPS:
        large = F.broadcast(large)
    rows = rows.join(large, F.col(key) == F.col("__key"), "left").drop("__key")
    blocks = F.coalesce(F.col("__blocks"), F.lit(1))
    rows = rows.withColumn("__own", F.pmod(F.xxhash64(id, F.lit(23)), blocks).cast("int"))
    rows = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
    cells = rows.withColumns(
        {
            "i": F.least("__own", "__other"),
            "j": F.greatest("__own", "__other"),
            "side": (F.col("__own") > F.col("__other")).cast("int"),
        }
    ).drop("__own", "__other", "__blocks")
    return cells.repartition(F.col(key), F.col("i"), F.col("j")).sortWithinPartitions(key, "i", "j", "side")


def compared(cells: DataFrame, key: str, schema: str, work: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``work`` on tables of whole cells."""

    def run(batches):
        for table in runs(batches, [key, "i", "j"]):
            yield from work(table)

    return bounded(cells).mapInArrow(run, schema)


def star_edges(cells: DataFrame, key: str, work: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> DataFrame:
    """The edges (u, v) that ``work`` makes of tables of whole cells, as stars, for ``components(starred=True)``."""

    def run(batches):
        return star_batches(edges for table in runs(batches, [key, "i", "j"]) for edges in work(table))

    return bounded(cells).mapInArrow(run, "u long, v long")


def linked_roots(links: np.ndarray) -> np.ndarray:
    """The least row that each row of a square link matrix reaches."""
    root = np.arange(len(links))
    while True:
        least = np.where(links, root[None, :], len(links)).min(axis=1, initial=len(links))
        new = np.minimum(root, least)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


