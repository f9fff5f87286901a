import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from messy import docs, no_docs
from pyspark.sql import functions as F

from voltlane.llm import language

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    found = language.op1(spark, FOLDER).join(truth, "doc_id").toPandas()
    assert len(found) == truth.count()
    assert found[["doc_id", "held_out", "lang_pred", "score"]].notna().all().all()
    assert found.score.between(0, 1).all()
    held_out = found[found.held_out]
    assert (held_out.lang == held_out.lang_pred).mean() > 0.98
    assert found.rejected.mean() < 0.01


def test_foreign_text_is_rejected_and_own_text_stays(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("n_chars > 100")
    model = language.train(table, language.not_held_out(table) & F.col("lang").isin("en", "fr", "de"))
    found = language.detect(table, model, "found").select("lang", "found.*").toPandas()
    assert found[found.lang == "es"].rejected.mean() > 0.9
    assert found[found.lang != "es"].rejected.mean() < 0.03


def test_probabilities_of_a_context_sum_to_one(spark):
    table = spark.createDataFrame(
        [(k, t, lang) for lang, t in (("a", "abracadabra"), ("b", "banana band")) for k in range(40)],
        "doc_id long, text string, lang string",
    )
    model = language.train(table, F.lit(True))
    alphabet = sorted({c for k in model.probs[1].hashes.tolist() for c in [k]})
    keys = np.array([language.START, language.SPACE, *map(ord, "abcdnr")], dtype=np.uint64)
    context = (np.uint64(ord("b")) << np.uint64(32)) | (np.uint64(ord("r")) << np.uint64(16)) | np.uint64(ord("a"))
    logs = model.logs(4, (context << np.uint64(16)) | keys)
    # One more symbol stands for all characters never met.
    total = np.exp2(logs.astype(float)).sum(axis=0)
    unseen = np.exp2(model.logs(4, np.array([(int(context) << 16) | 0x4E00], dtype=np.uint64)).astype(float))[0]
    assert len(alphabet) <= len(keys)
    assert np.allclose(total + unseen * (len(alphabet) + 1 - len(keys)), 1, atol=1e-3)


def test_messy_rows(spark):
    rows = language.detect(docs(spark), language.train(docs(spark), F.lit(True)), "language").collect()
    assert len(rows) == docs(spark).count()
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.language.lang_pred, r.language.score, r.language.rejected) == ("und", 0.0, True)
        else:
            assert r.language.lang_pred in ("en", "de")
    kept = language.keep_known(docs(spark))
    assert kept.columns == docs(spark).columns


def test_without_labels_or_rows(spark):
    assert language.train(no_docs(spark), F.lit(True)) is None
    assert language.keep_known(no_docs(spark)).count() == 0
    found = language.detect(docs(spark), None, "found").select("found.lang_pred").distinct().collect()
    assert [r[0] for r in found] == ["und"]


def test_find_in_sorted_hashes():
    keys = language.mix(np.arange(5000, dtype=np.uint64))
    level = language._level(np.arange(5000, dtype=np.uint64), np.arange(5000, dtype=np.float32)[:, None])
    assert (level.values[level.find(keys), 0] == np.arange(5000)).all()
    assert (level.find(language.mix(np.arange(5000, 9000, dtype=np.uint64))) == -1).all()


def level_rows(counts):
    """What ``_levels`` and its counts of counts give for counts of one language by order, all in one context."""
    rows = {c: [] for c in ("lang", "order", "gram", "n", "total", "ones", "twos")}
    for order, own in counts.items():
        n = list(own.values())
        for gram, k in own.items():
            row = ("a", order, sum(ord(c) << 16 * (order - 1 - i) for i, c in enumerate(gram)), k, sum(n), n.count(1), n.count(2))
            for column, value in zip(rows.values(), row):
                column.append(value)
    return pa.table(rows)


def test_a_cut_model_keeps_its_discounts_and_sums_to_one():
    own = {"a": 9, "b": 5, "c": 2, "d": 2, "e": 1, "f": 1, "g": 1}
    levels = level_rows({1: own, 2: {"x" + c: n for c, n in own.items()}})
    # As with a bound on the grams: the frequent ones of both orders are left.
    cut = levels.filter(pc.greater(levels.column("n"), 2))
    whole, model = language._build(levels), language._build(cut)
    keys = np.array([ord(c) for c in "ab"], dtype=np.uint64)
    discount = 3 / (3 + 2 * 2)
    unseen = np.exp2(float(model.unseen[0]))
    first = np.exp2(model.logs(1, keys).astype(float))[:, 0]
    assert np.allclose(first - unseen, [(n - discount) / 21 for n in (9, 5)], atol=1e-6)
    # One more symbol stands for all that were never met or left out.
    assert np.isclose(first.sum() + unseen, 1, atol=1e-5)
    pairs = np.exp2(model.logs(2, (np.uint64(ord("x")) << np.uint64(16)) | keys).astype(float))[:, 0]
    other = np.exp2(model.logs(2, np.array([(ord("x") << 16) | ord("c")], dtype=np.uint64)).astype(float))[0, 0]
    assert np.isclose(pairs.sum() + other, 1, atol=1e-5)
    assert np.isclose(np.exp2(whole.logs(1, keys).astype(float))[0, 0] - np.exp2(float(whole.unseen[0])), (9 - discount) / 21, atol=1e-6)


def test_rare_languages_are_calibrated_on_rows_of_their_own(spark):
    rng = np.random.default_rng(1)

    def text(letters):
        return " ".join("".join(rng.choice(list(letters), 5)) for _ in range(20))

    rows = [(k, text("abcde"), "a") for k in range(3000)] + [(3000 + k, text("vwxyz"), "b") for k in range(100)]
    table = spark.createDataFrame([*rows, (3100, text("klmno"), "c")], "doc_id long, text string, lang string")
    # 31 rows in all, of which "b" would have one by its share of the rows.
    model = language.train(table, F.lit(True), calibration_rows=31)
    assert model.langs == ["a", "b", "c"]
    assert (model.mean < 6).all() and (model.spread < 8).all() and (model.foreign >= 1.5 * model.mean).all()
    found = language.detect(table, model, "found").select("lang", "found.*").toPandas()
    assert found[found.lang == "b"].rejected.mean() < 0.05 and found[found.lang == "a"].rejected.mean() < 0.01
    strange = spark.createDataFrame([(k, text("πρστυ"), "a") for k in range(20)], "doc_id long, text string, lang string")
    assert language.detect(strange, model, "found").filter("found.rejected").count() == 20
