import re

import pytest
from messy import docs, no_docs
from pyspark.sql import functions as F

from voltlane.llm import mixing

FOLDER = "/root/testdata/sf0.01"


def expected_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight, again and again without those that reached their cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    out, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        capped = {s for s in open_ if most * sizes[s] <= level * weight[s]}
        if not capped:
            return out | {s: level * weight[s] for s in open_}
        out |= {s: most * sizes[s] for s in capped}
        open_ -= capped
        left -= sum(most * sizes[s] for s in capped)
    return out


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100, None: 40},
        {"a": 1, "b": 5000, "é": 7, "z": 0, "Z": 30, "": 12},
        {"only": 9},
        {"a": 0, "b": 0},
        {f"s{k}": (k * 37) % 11 for k in range(60)},
    ],
)
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(table).collect()}
    assert got == pytest.approx(expected_targets(sizes))


def test_query(spark):
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "source").toPandas()
    texts["words"] = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts.text]
    sizes = {s: int(g.words.sum()) for s, g in texts.groupby("source")}
    targets = expected_targets(sizes)
    rows = mixing.op9(spark, FOLDER).toPandas()
    own = rows.merge(texts, on="doc_id")
    assert len(own) == len(texts) and (own["size"] == own.words).all()
    for source, group in own.groupby("source_x"):
        assert (group.source_size == sizes[source]).all()
        assert group.target.iloc[0] == pytest.approx(targets[source])
        assert abs(group.taken.sum() - targets[source]) <= group["size"].max() / 2 + 1
    assert (own.taken <= 3 * own["size"]).all()
    share = own.target / own.source_size
    assert ((own.copies == share // 1) | (own.copies == share // 1 + 1)).all()
    again = mixing.op9(spark, FOLDER).toPandas()
    assert sorted(map(tuple, again.values)) == sorted(map(tuple, rows.values))


@pytest.mark.parametrize("block", [4, 32])
def test_tree_keeps_words_and_expectations(spark, block):
    n, p = 400, 0.3
    units = spark.range(n).select(
        F.lit("s").alias("source"), F.col("id"), (F.col("id") % 17 + 1).cast("double").alias("words"),
        F.lit(p).alias("p"), F.lit(n).cast("long").alias("n_units"),
    )
    up = [r.id for r in mixing.rounded_up(units, block).collect()]
    assert len(up) == len(set(up))
    total = sum(k % 17 + 1 for k in range(n))
    assert abs(sum(k % 17 + 1 for k in up) - p * total) <= 17 / 2 + 1e-6
    assert abs(len(up) / n - p) < 0.1


def test_a_hot_source_takes_small_blocks(spark):
    units = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("source"), "id",
        F.lit(2.0).alias("words"), F.lit(0.5).alias("p"),
    )
    counts = units.groupBy("source").agg(F.count("*").alias("n_units"))
    first = mixing._fold(units.join(counts, "source").withColumn("draw", F.xxhash64("id")), 16, 0)
    assert first.select(F.max(F.size("state.done"))).first()[0] < 64


def test_messy_rows(spark):
    rows = mixing.mix(docs(spark)).collect()
    assert len(rows) == docs(spark).count()
    assert all(r.copies == 0 for r in rows if r["size"] == 0)
    assert all(0 <= r.copies <= 3 for r in rows)
    by_document = {}
    for r in rows:
        if r["size"]:
            assert by_document.setdefault((r.source, r.doc_id), r.copies) == r.copies
    taken = mixing.mixed(docs(spark))
    assert taken.columns == docs(spark).columns
    assert taken.count() == sum(r.copies for r in rows)
    assert mixing.mix(no_docs(spark)).count() == 0 and mixing.mixed(no_docs(spark)).count() == 0


def test_plan_has_no_python(spark):
    plan = mixing.mix(docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_source_without_words(spark):
    rows = [(1, "", "a"), (2, None, "a"), (3, "some words here", "b"), (4, "and others", "b")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in mixing.mix(table).collect()}
    assert [found[k].copies for k in (1, 2)] == [0, 0] and found[1].target == 0 and found[3].copies == 1
    assert sorted(r.doc_id for r in mixing.mixed(table).collect()) == [3, 4]
