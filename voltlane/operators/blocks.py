"""Running and whole-group values without one task per group.

A window partitioned by session alone puts a session that holds a third of all rows into one task. Here the rows
of a key are cut into blocks of bounded size, each block is summarised on the map side, the short list of
summaries is scanned per key, and its result is joined back to the rows by (key, block). Where even that list is long, it
is scanned as a tree: stretches of ``FAN`` blocks are summarised and scanned in turn.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltlane.scratch import staged

ROWS_PER_BLOCK = 1_000_000
CELLS = 4096
# Parts of a crowded cell, and how many times their mean the fullest of them may have.
FINE, UNEVEN = 16, 2
FAN = 1024
MERGE = {"sum": F.sum, "min": F.min, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}
# Of a value over all that comes before a stretch, and one inside it.
JOIN = {
    "sum": lambda before, here: F.coalesce(before + here, before, here),
    "min": F.least,
    "max": F.greatest,
    "last": lambda before, here: F.coalesce(here, before),
}


@dataclass
class Blocked:
    """Rows with a column ``block``, and how many blocks there are."""

    rows: DataFrame
    blocks: int


def block_bounds(counts: dict[int, int], cells: int, size: int) -> tuple[list[int], list[int], int]:
    """For each cell its first block and its number of blocks, and the number of all blocks. Cells of few rows share a
    block, cells of more than ``size`` rows have as many as they need."""
    first, parts, block, filled = [], [], 0, 0
    for cell in range(cells):
        n = counts.get(cell, 0)
        own = -(-n // size) if n > size else 1
        if filled and filled + n > size:
            block, filled = block + 1, 0
        first.append(block)
        parts.append(own)
        block, filled = (block + own, 0) if own > 1 else (block, filled + n)
    return first, parts, block + (filled > 0)


def arrival_blocks(df: DataFrame, ord: str = "offset", size: int = ROWS_PER_BLOCK, stage: bool = True) -> Blocked:
    """Blocks of about ``size`` rows along ``ord``, whatever its values are: offsets of one partition, of several packed
    into one number, or with gaps. A histogram of ``CELLS`` cells over all rows says where they lie. Cells that need several
    blocks are cut evenly if a finer histogram shows that their rows lie evenly; if not, blocks are cut by ranges that Spark
    samples, which shuffles and writes the rows once more. A key has at most the rows of the block in each block.

    The histogram, the summaries and the rows all read the result: it is written once, unless ``df`` is a table already
    (``stage=False``)."""
    df = staged(df, "rows") if stage else df
    low, high, n = df.agg(F.min(ord), F.max(ord), F.count(ord)).first()
    if not n:
        return Blocked(df.withColumn("block", F.lit(0).cast("long")), 1)
    width = (high - low) // (CELLS if n > size else 1) + 1
    place = F.expr(f"`{ord}` - {low}L")
    cell = F.expr(f"(`{ord}` - {low}L) div {width}L")
    if n <= size:
        return Blocked(df.withColumn("block", cell), 1)
    counts = {r["cell"]: r["n"] for r in df.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect()}
    first, parts, blocks = block_bounds(counts, max(counts) + 1, size)
    # Lists as one constant each.
    listed = lambda values: F.from_json(F.lit(str(values)), "array<bigint>")
    block = F.get(listed(first), cell.cast("int"))
    if max(parts) > 1:
        inside = F.pmod(place, F.lit(width)) / F.lit(float(width))
        own = F.get(listed(parts), cell.cast("int"))
        fine = df.filter(own > 1).groupBy(cell.alias("cell"), F.floor(inside * FINE).alias("part"))
        fine = fine.agg(F.count("*").alias("n")).groupBy("cell").agg((F.max("n") * FINE / F.sum("n")).alias("uneven"))
        if width > 1 and fine.agg(F.max("uneven")).first()[0] > UNEVEN:
            return _ranges(df, [ord], -(-n // size))
        block = block + F.least(F.floor(inside * own), own - 1)
    return Blocked(df.withColumn("block", block), blocks)


def _ranges(rows: DataFrame, order: list[str], n: int) -> Blocked:
    cut = rows.repartitionByRange(n, *order).withColumn("block", F.spark_partition_id().cast("long"))
    return Blocked(staged(cut, "blocks"), n)


def range_blocks(df: DataFrame, order: list[str], blocks: int | None = None, size: int = ROWS_PER_BLOCK) -> Blocked:
    """Blocks of about equal size along ``order``, which ends in a unique column: as many as ``size`` rows each make, and
    at least one for each shuffle partition. Spark picks the bounds by sampling, so the rows are written before, to be
    read once, and after, so that branches agree on the blocks."""
    rows = staged(df, "rows")
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = blocks or max(least, -(-rows.count() // size))
    return _ranges(rows, order, n)


def _merged(merges: dict[str, str]) -> list[Column]:
    """Summaries of summaries, in the order of blocks."""
    last = lambda n: F.max_by(n, F.when(F.col(n).isNotNull(), F.col("block")))
    return [(last(n) if how == "last" else MERGE[how](F.col(n))).alias(n) for n, how in merges.items()]


def _before(summary: DataFrame, keys: list[str], merges: dict[str, str], blocks: int) -> DataFrame:
    """Per (key, block) each value merged over the earlier blocks of the key; no row where there are none."""
    earlier = (Window.unboundedPreceding, -1)
    if blocks <= FAN:
        over = Window.partitionBy(*keys).orderBy("block").rowsBetween(*earlier)
        first = F.min("block").over(Window.partitionBy(*keys)).alias("first")
        merged = [MERGE[how](F.col(n)).over(over).alias(n) for n, how in merges.items()]
        return summary.select(*keys, "block", *merged, first).filter("block > first").drop("first")
    parts = staged(summary.withColumn("stretch", F.expr(f"block div {FAN}")), "summaries")
    stretches = parts.groupBy(*keys, F.col("stretch").alias("block")).agg(*_merged(merges))
    above = _before(stretches, keys, merges, -(-blocks // FAN)).withColumnsRenamed(
        {"block": "stretch"} | {n: f"{n}Above" for n in merges}
    )
    over = Window.partitionBy(*keys, "stretch").orderBy("block").rowsBetween(*earlier)
    inside = parts.withColumns({n: MERGE[how](F.col(n)).over(over) for n, how in merges.items()})
    joined = inside.join(above, [*keys, "stretch"], "left")
    return joined.select(*keys, "block", *[JOIN[how](F.col(f"{n}Above"), F.col(n)).alias(n) for n, how in merges.items()])


def carry(
    blocked: Blocked, keys: list[str], totals: dict[str, tuple[Column, str]], whole_group: bool = False
) -> DataFrame:
    """Per (key, block): each total merged over the earlier blocks of the key, or over all of them. Without
    earlier blocks there is no row, so only the keys that span blocks cost anything.

    ``totals`` maps a name to the aggregate that summarises a block and the way summaries merge."""
    summary = blocked.rows.groupBy(*keys, "block").agg(*[agg.alias(name) for name, (agg, _) in totals.items()])
    merges = {name: how for name, (_, how) in totals.items()}
    if not whole_group:
        return _before(summary, keys, merges, blocked.blocks)
    if blocked.blocks <= FAN:
        over = Window.partitionBy(*keys).orderBy("block")
        over = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return summary.select(*keys, "block", *[MERGE[how](F.col(n)).over(over).alias(n) for n, how in merges.items()])
    summary = staged(summary, "summaries")
    whole = summary.groupBy(*keys).agg(*_merged(merges))
    return summary.select(*keys, "block").join(whole, keys)


def with_carry(
    windowed: DataFrame, blocked: Blocked, keys: list[str], totals: dict[str, tuple[Column, str]], whole_group=False
) -> DataFrame:
    """Rows with the totals of their key. ``windowed`` is ``blocked.rows``, or these after in-block windows, which leave
    the rows partitioned and sorted as the join wants them."""
    how = "inner" if whole_group else "left"
    return windowed.join(carry(blocked, keys, totals, whole_group), [*keys, "block"], how)


def in_block(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys, "block").orderBy(*order)
