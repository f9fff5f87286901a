"""Blocks of bounded size whatever offsets look like, and scans of them in several levels."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from voltlane.operators import blocks as B
from voltlane.operators import epochs, topics
from voltlane.sources.messages import PARTITIONS


def rows_of(kind, n, seed=1):
    """(offset, key, stop), a third of the rows of one key, in order of offset."""
    rng = random.Random(seed)
    if kind == "one partition":
        offsets = range(n)
    elif kind == "ten partitions":
        offsets = sorted((k // 10) * PARTITIONS + k % 10 for k in range(n))
    elif kind == "far apart":
        offsets = [10**15 + k * 10**9 for k in range(n)]
    else:  # clumps with a gap of a trillion, one of them dense, the other sparse
        offsets = [*range(n // 2), *(10**12 + 7 * k for k in range(n - n // 2))]
    return [(o, "hot" if i % 3 == 0 else f"k{rng.randrange(20)}", rng.random() < 0.05) for i, o in enumerate(offsets)]


KINDS = ["one partition", "ten partitions", "far apart", "clumps"]


def table(spark, rows):
    return spark.createDataFrame(rows, "offset long, key string, stop boolean")


@pytest.mark.parametrize("kind", KINDS)
def test_blocks_are_bounded_and_follow_the_order(spark, kind):
    n, size = 6000, 200
    blocked = B.arrival_blocks(table(spark, rows_of(kind, n)), "offset", size)
    found = sorted((r.offset, r.block) for r in blocked.rows.collect())
    by_order = [b for _, b in found]
    assert by_order == sorted(by_order) and by_order[0] == 0 and by_order[-1] < blocked.blocks
    sizes = Counter(by_order)
    assert max(sizes.values()) <= 2 * size
    # No more than it takes: the hot key's summaries are few, not as many as its rows.
    assert n / size / 2 <= len(sizes) <= 2 * n / size + 2


def test_partitions_of_a_topic_make_no_more_blocks(spark):
    one, ten = (B.arrival_blocks(table(spark, rows_of(k, 6000)), "offset", 200).blocks for k in KINDS[:2])
    assert ten <= 1.5 * one


def test_few_rows_are_one_block(spark):
    blocked = B.arrival_blocks(table(spark, rows_of("far apart", 100)), "offset", 200)
    assert blocked.blocks == 1 and {r.block for r in blocked.rows.select("block").collect()} == {0}
    none = B.arrival_blocks(table(spark, []), "offset", 200)
    assert none.blocks == 1 and none.rows.count() == 0


def test_bounds_split_crowded_cells_and_join_empty_ones():
    first, parts, blocks = B.block_bounds({0: 5, 1: 5, 2: 35, 3: 1, 7: 10}, 8, 10)
    assert first == [0, 0, 1, 5, 5, 5, 5, 6] and parts == [1, 1, 4, 1, 1, 1, 1, 1] and blocks == 7


def plain_epochs(rows):
    stops, want = defaultdict(int), {}
    for offset, key, stop in rows:
        want[offset] = stops[key]
        stops[key] += stop
    return want


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("fan", [B.FAN, 3])
def test_epochs_of_a_hot_key(spark, monkeypatch, kind, fan):
    monkeypatch.setattr(B, "FAN", fan)
    rows = rows_of(kind, 3000)
    found = epochs.with_epoch(table(spark, rows), ["key"], F.col("stop"), rows_per_block=50)
    assert {r.offset: r.epoch for r in found.collect()} == plain_epochs(rows)


@pytest.mark.parametrize("fan", [B.FAN, 3])
def test_every_way_of_merging_on_several_levels(spark, monkeypatch, fan):
    """About 60 blocks in stretches of three: four levels."""
    monkeypatch.setattr(B, "FAN", fan)
    rng = random.Random(4)
    rows = [(o, k, rng.randrange(1000) if rng.random() < 0.3 else None) for o, k, _ in rows_of("ten partitions", 1500)]
    df = spark.createDataFrame(rows, "offset long, key string, v long")
    blocked = B.arrival_blocks(df, "offset", 25)
    assert blocked.blocks > 27
    last = F.max_by("v", F.when(F.col("v").isNotNull(), F.col("offset")))
    totals = {"s": (F.sum("v"), "sum"), "lo": (F.min("v"), "min"), "hi": (F.max("v"), "max"), "l": (last, "last")}
    block = {r.offset: r.block for r in blocked.rows.collect()}
    found = {(r.key, r.block): (r.s, r.lo, r.hi, r.l) for r in B.carry(blocked, ["key"], totals).collect()}
    whole = {(r.key, r.block): (r.s, r.lo, r.hi, r.l) for r in B.carry(blocked, ["key"], totals, True).collect()}
    of = defaultdict(list)
    for offset, key, v in rows:
        of[key].append((block[offset], v))
    for key, values in of.items():
        said = lambda vs: (sum(vs), min(vs), max(vs), vs[-1]) if vs else (None,) * 4
        for b in {b for b, _ in values}:
            assert found.get((key, b), (None,) * 4) == said([v for c, v in values if c < b and v is not None])
            assert whole[key, b] == said([v for _, v in values if v is not None])


def test_tombstones_of_a_hot_key_in_a_partitioned_topic(spark, monkeypatch):
    monkeypatch.setattr(B, "FAN", 2)
    rows = rows_of("ten partitions", 2000)
    log = [("t", k, None if stop else "v", o) for o, k, stop in rows]
    df = spark.createDataFrame(log, "topic string, key string, value string, offset long")
    found = {r.offset for r in topics.after_last_tombstone(df, rows_per_block=40).collect()}
    last = {k: o for o, k, stop in rows if stop}
    assert found == {o for o, k, stop in rows if not stop and o > last.get(k, -1)}


def test_range_blocks_grow_in_number_with_the_rows(spark):
    df = spark.createDataFrame([("hot" if k % 3 else f"k{k}", k) for k in range(4000)], "key string, offset long")
    blocked = B.range_blocks(df, ["key", "offset"], size=200)
    sizes = [r.n for r in blocked.rows.groupBy("block").agg(F.count("*").alias("n")).collect()]
    assert blocked.blocks == 20 and max(sizes) <= 2 * 200
