"""Sessions that reuse a transaction id: which run of the id a message belongs to."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlane.operators import blocks as B


def with_epoch(
    rows: DataFrame,
    keys: list[str],
    is_stop: Column,
    ord: str = "offset",
    rows_per_block: int = B.ROWS_PER_BLOCK,
    stage: bool = True,
) -> DataFrame:
    """Adds the number of earlier stops under the same key, in arrival order."""
    blocked = B.arrival_blocks(rows.withColumn("stopFlag", is_stop.cast("long")), ord, rows_per_block, stage)
    earlier = B.in_block(keys, [ord]).rowsBetween(B.Window.unboundedPreceding, -1)
    windowed = blocked.rows.withColumn("epoch", F.coalesce(F.sum("stopFlag").over(earlier), F.lit(0)))
    joined = B.with_carry(windowed, blocked, keys, {"stopsBefore": (F.sum("stopFlag"), "sum")})
    epoch = F.col("epoch") + F.coalesce("stopsBefore", F.lit(0))
    return joined.withColumn("epoch", epoch).drop("block", "stopFlag", "stopsBefore")
