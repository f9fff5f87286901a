"""Charger log files: one ``charger : [call]`` per line."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARSED = (
    "file STRING, ord STRUCT<block: BIGINT, line: BIGINT>, written TIMESTAMP, line STRING, chargerId STRING, kind STRING, "
    "uniqueId STRING, message STRING, elements INT, reason STRING"
)


def _content(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r\n\f\x0b"))


def content_lines(lines: DataFrame) -> DataFrame:
    """Without blank lines and comments."""
    return lines.filter((F.length("line") > 0) & ~F.col("line").startswith("#"))


def read_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines as (file, ord, line), without blank lines and comments.

    ``ord`` follows the lines of one file: splits by their start in the file, lines by their place in the split.
    It says nothing across files."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
        ).alias("ord"),
        _content(F.col("value")).alias("line"),
    )
    return content_lines(lines)


@F.arrow_udf(T.LongType())
def _place(splits: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Numbers the lines of each split, given by file and start; a task gets a split's lines in order and in one go."""
    last, count = None, 0
    for columns in splits:
        file, block = (c.to_numpy(zero_copy_only=False) for c in columns)
        n = len(file)
        new = np.ones(n, dtype=bool)
        new[1:] = (file[1:] != file[:-1]) | (block[1:] != block[:-1])
        if n and last == (file[0], block[0]):
            new[0] = False
        starts = np.flatnonzero(new)
        place = np.arange(n) + count
        for a, b in zip(starts, np.append(starts[1:], n)):
            place[a:b] = np.arange(b - a)
        if n:
            last, count = (file[-1], block[-1]), int(place[-1]) + 1
        yield pa.array(place, pa.int64())


def read_log_stream(spark: SparkSession, folder: str, clock: Column | None = None, **options) -> DataFrame:
    """New log files of a folder as they arrive: (file, ord, written, arrival, line).

    ``ord`` is the place of a line in its file, as in ``read_log``: the start of its split and its number there. A stream
    has no ``monotonically_increasing_id``, so lines are numbered in Python, which gets two numbers of each, not the text.

    ``written`` is the time on the file. ``arrival`` is when the stream took the line in, the same for a whole batch and
    rising from batch to batch, so no line is ever behind the watermark, however old its file. ``clock`` replaces it."""
    lines = spark.readStream.format("text").options(**options).load(folder)
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_modification_time").alias("written"),
        (F.current_timestamp() if clock is None else clock).alias("arrival"),
        _content(F.col("value")).alias("line"),
    )
    # Numbered before blank lines and comments go, and before anything can be filtered below it.
    number = _place.asNondeterministic()(F.xxhash64("file"), F.col("block"))
    return content_lines(
        lines.select("file", F.struct("block", number.alias("line")).alias("ord"), "written", "arrival", "line")
    )


def keep_parsed(parsed: DataFrame, folder: str, checkpoint: str, **trigger):
    """Starts a query that writes the parsed lines of ``read_log_stream`` to a folder, once each, for a stream that reads
    them several times: each branch of a streaming query reads its source anew, and would parse every line again."""
    writer = parsed.drop("arrival").writeStream.format("parquet").option("path", folder)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_parsed_stream(spark: SparkSession, folder: str, clock: Column | None = None) -> DataFrame:
    """The lines of ``keep_parsed`` as they arrive, with ``arrival`` as in ``read_log_stream``: the time of this stream's
    batch, not of the one that parsed them."""
    lines = spark.readStream.schema(PARSED).parquet(folder)
    return lines.withColumn("arrival", F.current_timestamp() if clock is None else clock)
