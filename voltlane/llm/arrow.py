"""Small helpers for Arrow batches inside tasks."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20


def bounded(df: DataFrame) -> DataFrame:
    """``df``, once its session passes at most ``BATCH_BYTES`` of rows at a time to Python, or one row. By default a batch
    is bounded by 64 MB, and long texts would be held several times over in each worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """Consecutive parts of a string array of about ``limit`` bytes each; one longer text is a part of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at, done = 0, 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield texts.slice(at, stop - at)
        at, done = stop, int(ends[stop - 1])


def strings(texts: pa.Array) -> list[str]:
    """Texts as Python strings; null counts as empty."""
    return ["" if t is None else t for t in texts.to_pylist()]


def runs(batches, keys: list[str]):
    """Tables that hold whole groups, from batches sorted by ``keys``. A batch's last group waits for the next batch;
    so memory holds one batch and one group."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        starts = group_starts([table.column(k) for k in keys])
        cut = int(starts[-1])
        if cut:
            yield table.slice(0, cut).combine_chunks()
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def group_starts(columns) -> np.ndarray:
    """First positions of the runs of equal values."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for column in columns:
        values = column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)
