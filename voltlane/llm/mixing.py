"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

A source's target in words sets how often its documents are taken on average: a whole number of times for all of them,
and once more for a share. That share is rounded document by document, but not independently. Two fractional documents
meet, and a random one of them gives words to the other until one of the two is at 0 or 1; the chances are such that
every document keeps its expectation, and the words of the pair stay the same. So the words of a source stay at its
target up to the last fractional document, which is rounded to the nearer side.

The pairs form a reduction tree. Documents are dealt by hash into blocks of about ``BLOCK``; within a block, larger
documents first, a fold lets the one that is still fractional meet the next. Each block leaves at most one; these are
dealt into blocks again, until a source has one block. A hot source only has more blocks. All draws are hashes of the
documents that meet, so reruns agree.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltlane.scratch import staged

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 256
BROADCAST_SOURCES = 100_000
NEAR = 1e-9


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def targets(by_source: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """``by_source`` (source, source_size; one row each) with ``target``.

    Sources in code point order, null last, take the weights in turn. Targets share the sum of all sizes by weight, and
    stop at ``most`` times the source's size, the excess going to the others by weight. That is the smaller of the cap
    and one level times the weight; in order of cap over weight, the level is the largest of what is left per weight.
    The two windows see one row per source."""
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    cap = F.col("source_size") * float(most)
    rows = by_source.withColumn("weight", weight).withColumn("cap", cap)
    before = Window.orderBy(F.col("cap") / F.col("weight"), "source").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", level).withColumn("level", F.max("level").over(whole))
    return rows.withColumn("target", F.least("cap", F.col("level") * F.col("weight"))).drop("weight", "cap", "level")


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once."""
    return F.transform(F.array(value), then)[0]


def _draw(*columns) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _settled(p: Column) -> Column:
    return F.when(p < NEAR, F.lit(0.0)).when(p > 1 - NEAR, F.lit(1.0)).otherwise(p)


def _is_open(p: Column) -> Column:
    return (p > 0) & (p < 1)


def _unit(x: Column, p: Column) -> Column:
    return F.struct(x["words"].alias("words"), x["draw"].alias("draw"), x["id"].alias("id"), p.alias("p"))


def _meet(state: Column, x: Column) -> Column:
    """The fractional document of the state meets ``x``: one gives words until one of them is whole."""
    a = state["held"]
    to_a = F.least((1 - a["p"]) * a["words"], x["p"] * x["words"])
    to_x = F.least(a["p"] * a["words"], (1 - x["p"]) * x["words"])

    def moved(w):
        gain = F.when(_draw(a["draw"], x["draw"], F.lit(7)) * (w["to_a"] + w["to_x"]) < w["to_x"], w["to_a"]).otherwise(
            -w["to_x"]
        )
        return _let(gain, lambda g: F.struct(_settled(a["p"] + g / a["words"]).alias("a"), _settled(x["p"] - g / x["words"]).alias("x")))

    def next_state(p):
        ended = F.filter(F.array(_unit(a, p["a"]), _unit(x, p["x"])), lambda u: ~_is_open(u["p"]))
        held = F.when(_is_open(p["a"]), _unit(a, p["a"])).when(_is_open(p["x"]), _unit(x, p["x"]))
        return F.struct(held.alias("held"), F.concat(state["done"], ended).alias("done"))

    both = _let(_let(F.struct(to_a.alias("to_a"), to_x.alias("to_x")), moved), next_state)
    return F.when(a.isNull(), F.struct(x.alias("held"), state["done"].alias("done"))).otherwise(both)


def _fold(units: DataFrame, size: int, seed: int) -> DataFrame:
    """One level of the tree, in blocks of so many of a source's first units: of each block, the documents that it
    settled and the one that it leaves, if any."""
    blocks = F.ceil(F.col("n_units") / size)
    block = F.pmod(F.xxhash64("draw", F.lit(seed)), blocks)
    unit = F.struct("words", "draw", "id", "p")
    met = units.groupBy("source", "n_units", block.alias("block")).agg(
        F.sort_array(F.collect_list(unit), asc=False).alias("met")
    )
    kind = met.schema["met"].dataType
    start = F.struct(F.lit(None).cast(kind.elementType).alias("held"), F.array().cast(kind).alias("done"))
    return met.select("source", "n_units", F.aggregate("met", start, _meet).alias("state"))


def rounded_up(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """Of units (source, id, words, p, n_units of the source), those whose p is rounded up: (source, id).

    p lies between 0 and 1, words above 0; ids are distinct within a source."""
    largest = units.agg(F.max("n_units")).first()[0] or 1
    level, size, out, depth = units.withColumn("draw", F.xxhash64("id", F.lit(1))), 1, [], 0
    while True:
        size *= block
        state = staged(_fold(level, size, depth), "mix").select("source", "n_units", "state.*")
        out.append(state.select("source", F.explode("done").alias("u")).select("source", "u.id", "u.p"))
        level = state.filter("held is not null").select("source", "n_units", "held.*")
        depth += 1
        if size >= largest:
            break
    last = (F.col("p") >= 0.5).cast("double")  # to the nearer side: at most half a document off
    out.append(level.select("source", "id", last.alias("p")))
    ended = out[0]
    for part in out[1:]:
        ended = ended.unionByName(part)
    return ended.filter("p = 1").select("source", "id")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """Of each row of ``docs`` (doc_id, source, text): doc_id, source, size in words, source_size, target, copies.

    Null texts and texts without a word have size 0 and are not taken. A null source is a source of its own. Rows that
    share source and doc_id are one document, taken alike. No row has more than ``most`` copies."""
    narrow = staged(docs.select("doc_id", "source", word_count().alias("size")), "sizes")
    units = narrow.groupBy("source", F.col("doc_id").alias("id")).agg(F.sum("size").alias("words"))
    of = units.groupBy("source").agg(
        F.sum("words").alias("source_size"), F.count_if(F.col("words") > 0).alias("n_units")
    )
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    of = targets(of, weights, most).withColumn("each", F.least(share, F.lit(float(most))))
    of = of.withColumn("base", F.floor(F.coalesce(F.col("each"), F.lit(0.0)) + NEAR))
    of = staged(of.withColumn("p", F.greatest(F.col("each") - F.col("base"), F.lit(0.0))), "sources")
    if of.count() <= BROADCAST_SOURCES:
        of = F.broadcast(of)
    open_ = units.join(of, units["source"].eqNullSafe(of["source"])).filter((F.col("p") > NEAR) & (F.col("words") > 0))
    up = rounded_up(open_.select(units["source"], "id", F.col("words").cast("double"), "p", "n_units"))
    up = up.select(F.col("source").alias("s"), F.col("id").alias("i"), F.lit(1).alias("up"))
    rows = narrow.join(of, narrow["source"].eqNullSafe(of["source"])).drop(of["source"])
    rows = rows.join(up, rows["source"].eqNullSafe(up["s"]) & rows["doc_id"].eqNullSafe(up["i"]), "left")
    copies = F.when(F.col("size") > 0, F.col("base") + F.coalesce(F.col("up"), F.lit(0))).otherwise(F.lit(0))
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.cast("int").alias("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; columns stay as they are. Rows come from their own source
    and doc_id, so rows that share them are repeated alike."""
    taken = mix(docs).filter("copies > 0").select(
        F.col("source").alias("__source"), F.col("doc_id").alias("__doc_id"), F.col("copies").alias("__copies")
    )
    taken = taken.distinct()
    same = docs["source"].eqNullSafe(taken["__source"]) & docs["doc_id"].eqNullSafe(taken["__doc_id"])
    rows = docs.join(taken, same).filter(word_count() > 0)
    copy = F.explode(F.sequence(F.lit(1), F.col("__copies")))
    return rows.withColumn("__copy", copy).select(*[docs[f"`{c}`"] for c in docs.columns])


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mix(docs).select("doc_id", "size", "source_size", "target", taken, "source", "copies")
