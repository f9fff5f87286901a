import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from messy import docs, no_docs, rows

from voltlane.llm import quality

FOLDER = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    good = label == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def labelled(spark):
    return {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}


def test_held_out_accuracy(spark):
    found = quality.op13(spark, FOLDER).collect()
    label = labelled(spark)
    assert len(found) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    own = [r for r in found if r.held_out and r.doc_id in label]
    score, truth = np.array([r.score for r in own]), np.array([label[r.doc_id] for r in own])
    assert auc(score, truth) > 0.98
    assert np.mean((score >= 0.5) == (truth == 1)) > 0.95


def test_only_text_and_labels_of_other_rows_count(spark, tmp_path):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    label = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = quality.held_out()
    table.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    label = label.withColumn("quality", quality.F.when(held, 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    label.select("doc_id", "quality").write.parquet(f"{tmp_path}/labels.parquet")
    one = {r.doc_id: r.score for r in quality.op13(spark, FOLDER).collect()}
    other = {r.doc_id: r.score for r in quality.op13(spark, str(tmp_path)).collect()}
    assert one.keys() == other.keys() and max(abs(one[k] - other[k]) for k in one) < 1e-9


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.86])
def test_prior_is_found(prior):
    rng = np.random.default_rng(1)
    good = lambda n: rng.beta(8, 2, n)
    mixed = np.where(rng.random(40_000) < prior, good(40_000), rng.beta(2, 8, 40_000))
    binned = lambda x: np.bincount((x * 999).astype(int), minlength=1000)
    assert abs(quality.prior_of(binned(good(20_000)), binned(mixed)) - prior) < 0.04


def test_risk_of_a_mixture_is_that_of_known_labels():
    """On unlabelled rows with known truth, the classifier comes near the best one there is."""
    rng = np.random.default_rng(2)
    width = quality.MEASURES + 3
    centre = np.zeros(width)
    centre[:4] = 1.2
    truth = rng.random(6000) < 0.7
    unlabelled = rng.standard_normal((6000, width)) + np.where(truth[:, None], centre, -centre)
    positive = rng.standard_normal((3000, width)) + centre
    model = quality.Classifier.scaled(unlabelled).fitted(positive, unlabelled, 0.7)
    best = (unlabelled @ centre * 2 + np.log(0.7 / 0.3)) > 0
    assert np.mean((model.odds(unlabelled) > 0) == truth) > np.mean(best == truth) - 0.025
    assert abs(quality._sigmoid(model.odds(unlabelled)).mean() - 0.7) < 0.05


def brute_measures(text):
    words = re.findall(r"\S+", text)
    lines = re.split(r"\n", text)
    lines = lines[:-1] if lines[-1] == "" else lines
    pairs = list(zip(words, words[1:]))
    count = Counter(words)
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        sum(map(len, words)) / len(words),
        sum(not any(c.isalpha() for c in w) for w in words) / len(words),
        sum(a == b for a, b in pairs) / len(words),
        len(count) / len(words),
        max(count.values()) / len(words),
        len(set(pairs)) / len(pairs) if pairs else 0,
        (len(lines) - len(set(lines))) / len(lines),
        np.log1p(len(text) / len(lines)),
        sum(a == b and not b.isspace() for a, b in zip(text, text[1:])) / len(text),
        sum(c.isupper() for c in text) / max(1, sum(c.isalpha() for c in text)),
    ]


def test_measures_equal_plain_python():
    texts = ["one", "The cat sat on the mat.", "a a a a b b", "X!! YY!! x", "### $$ 12", "a b\na b\nc  d\n", "\n\nab ab\n", "élan Ürsprung"]
    found = quality.measured(["", *texts, ""])
    assert not found[0].any() and not found[-1].any()
    for text, row in zip(texts, found[1:-1]):
        assert np.allclose(row[: quality.MEASURES], brute_measures(text)), text
    assert np.allclose(found[1 + 1, quality.MEASURES + quality.LOWER * quality.CLASSES + quality.SPACE] ** 2, 5 / 22)
    # A text's measures don't depend on its neighbours.
    for text, row in zip(texts, found[1:-1]):
        assert np.array_equal(quality.measured([text])[0], row)


def test_messy_rows(spark):
    good = spark.createDataFrame([(k,) for k in range(0, 12)] + [(None,), (3,)], "doc_id long")
    many = docs(spark)
    for _ in range(3):
        many = many.unionByName(many)
    model = quality.train(many, good)
    assert model is not None
    found = quality.scored(many, model, name="score").collect()
    assert len(found) == 8 * len(rows()) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if not r.text}) == 1
    empty = model.scores(pa.array(["", None]))
    assert empty[0] == empty[1]


def test_empty_tables_and_few_labels(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert quality.train(no_docs(spark), none) is None
    assert quality.train(docs(spark), none) is None
    assert quality.scored(no_docs(spark), None).count() == 0
    assert {r.quality for r in quality.scored(docs(spark), None).collect()} == {0.5}
