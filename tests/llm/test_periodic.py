import hashlib
import random
import zlib
from fractions import Fraction

from messy import docs, no_docs, rows
from oracle import connect, spark_rows, sql_rows

from voltlane.llm import periodic

FOLDER = "/root/testdata/sf0.001"


def brute_runs(words):
    """Every maximal stretch of every lag; of the same stretch, the least lag."""
    n, found = len(words), {}
    for d in range(1, n // 4 + 1):
        i = d
        while i < n:
            j = i
            while j < n and words[j] == words[j - d]:
                j += 1
            if j - i + d >= max(6, 4 * d):
                found.setdefault((i - d, j - i + d), d)
            i = j + 1
    return sorted((s, n, d) for (s, n), d in found.items())


def brute_collapsed(words):
    gone = {i for s, n, d in brute_runs(words) for i in range(s + d, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def made_texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        letters = "abcdefgh"[: rng.choice([1, 2, 3, 8])]
        words = []
        while len(words) < rng.randint(0, 70):
            root = [rng.choice(letters) for _ in range(rng.randint(1, 14))]
            words += (root * rng.randint(1, 9))[: rng.randint(1, 90)] if rng.random() < 0.5 else root[:1]
        yield words


def test_runs_equal_brute_force():
    texts = list(made_texts(1, 3000))
    found = periodic.runs_of_texts(texts)
    assert sum(map(len, found)) > 2000
    for words, runs in zip(texts, found):
        assert [(s, n, d) for s, n, d in runs] == sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
        assert periodic.collapsed(words, runs) == brute_collapsed(words)


def test_long_periods_at_every_scale():
    for period in (1, 2, 3, 4, 6, 7, 10, 11, 16, 17, 25, 26, 39, 40, 150):
        root = [f"w{k}" for k in range(period)]
        for n in (max(6, 4 * period) - 1, max(6, 4 * period), 5 * period + 3, 9 * period + 5):
            words = ["x", "y"] + (root * 15)[:n] + ["z"]
            own = [(2, n, period)] if n >= max(6, 4 * period) else []
            assert periodic.runs_of_texts([words]) == [own], (period, n)


def test_a_word_has_one_lag_on_each_scale():
    words = ["a"] * 30_000 + ["b", "a", "a", "a"] * 10_000
    number = {"a": 0, "b": 1}
    numbers = periodic.np.array([number[w] for w in words])
    place = periodic.np.arange(len(words))
    position, lag, _ = periodic.matches(numbers, place, place * 0, len(words))
    assert periodic.np.unique(position, return_counts=True)[1].max() <= len(list(periodic.scales(len(words) // 4)))
    assert set(lag.tolist()) == {1, 4}
    # The three words before the first b belong to its run as well.
    assert periodic.runs_of_texts([words]) == [[(0, 30_000, 1), (29_997, 40_003, 4)]]


def test_texts_do_not_run_into_each_other():
    texts = [["a"] * 5, ["a"] * 5, [], ["a"] * 6, ["b", "a"]]
    assert periodic.runs_of_texts(texts) == [[], [], [], [(0, 6, 1)], []]


def test_messy_rows(spark):
    found = periodic.periodic_runs(docs(spark), name="path").collect()
    assert len(found) == len(rows())
    for r in found:
        words = periodic._words(r.text or "")
        runs = [tuple(x) for x in r.path.runs]
        assert r.path.n_words == len(words)
        if len(words) < 1000:
            assert runs == sorted(brute_runs(words), key=lambda x: (x[0], x[2]))
        assert r.path.collapsed == " ".join(periodic.collapsed(words, runs))
        assert (r.lang, r.language) in {(x[2], x[6]) for x in rows()}
    assert periodic.periodic_runs(no_docs(spark)).count() == 0


def test_runs_in_long_texts(spark):
    words = [f"word{k % 997}" for k in range(30_000)]
    text = spark.createDataFrame([(1, " \n".join(words)), (2, "a " * 100_000)], "doc_id long, text string")
    found = {r.doc_id: r.periodic for r in periodic.periodic_runs(text).collect()}
    assert [tuple(r) for r in found[1].runs] == [(0, 30_000, 997)] and found[1].collapsed == " ".join(words[:997])
    assert [tuple(r) for r in found[2].runs] == [(0, 100_000, 1)] and found[2].collapsed == "a"


def contract(doc_id, text):
    words = periodic._words(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else None
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    listed = "".join(f"{s},{n},{d}\n" for s, n, d in runs)
    one = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *one, sha(listed), sha(" ".join(brute_collapsed(words))))


def test_query_equals_brute_force(spark, tmp_path):
    texts = [" ".join(w) for w in made_texts(2, 400)]
    table = [(k, t) for k, t in enumerate(texts)] + [(r[0], r[1]) for r in rows() if len(r[1] or "") < 6000]
    spark.createDataFrame(table, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in periodic.op11(spark, str(tmp_path)).collect()]
    assert sorted(found, key=repr) == sorted((contract(*r) for r in table), key=repr)


def test_query_equals_sql(spark):
    assert spark_rows(periodic.op11(spark, FOLDER)) == sql_rows(connect(FOLDER), periodic.SQL)
